import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from deliverylens.functions.payload import (FieldSpec, cast_failures, comma_list, extract, field_col, field_of,
                                            fields_read, parse_payload, strip_markup, walkable, with_path_levels)


def _one(spark, text, spec):
    df = spark.createDataFrame([(text,)], "j string").withColumn("v", parse_payload("j", lenient=True))
    return extract(df, "v", [spec]).first()[0]


def test_int_truncates_fraction(spark):
    assert _one(spark, '{"p": 3.5}', FieldSpec("p", "$.p", "int")) == 3


def test_strict_cast_raises_and_try_gives_null(spark):
    with pytest.raises(PySparkException):
        _one(spark, '{"p": "x"}', FieldSpec("p", "$.p", "int"))
    assert _one(spark, '{"p": "x"}', FieldSpec("p", "$.p", "int", "try")) is None


def test_object_read_as_string_is_json_text(spark):
    out = _one(spark, '{"d": {"type": "doc", "n": 1}}', FieldSpec("d", "$.d"))
    assert out.replace(" ", "") in ('{"n":1,"type":"doc"}', '{"type":"doc","n":1}')


def test_missing_and_json_null_are_null(spark):
    assert _one(spark, '{"a": null}', FieldSpec("a", "$.a")) is None
    assert _one(spark, '{}', FieldSpec("a", "$.a.b")) is None


def test_arrays(spark):
    assert _one(spark, '{"f": null}', FieldSpec("f", "$.f", "array<variant>")) is None
    with pytest.raises(PySparkException):
        _one(spark, '{"f": 5}', FieldSpec("f", "$.f", "array<variant>"))
    assert _one(spark, '{"l": [1, "a", null]}', FieldSpec("l", "$.l", "array<string>")) == ["1", "a", None]


def test_timestamp_offsets(spark):
    out = _one(spark, '{"t": "2024-03-01T10:00:00.123-0300"}', FieldSpec("t", "$.t", "timestamp"))
    assert out == dt.datetime(2024, 3, 1, 13, 0, 0, 123000)


def test_dotted_key_path(spark):
    assert _one(spark, '{"fields": {"System.State": "Active"}}',
                FieldSpec("s", '$.fields["System.State"]')) == "Active"


def test_bad_json_strict_vs_lenient(spark):
    df = spark.createDataFrame([('{"k": 1',)], "j string")
    assert df.select(parse_payload("j", lenient=True).isNull()).first()[0]
    with pytest.raises(Exception):  # malformed JSON surfaces as a task failure
        df.select(parse_payload("j")).collect()


def test_cast_failures_counts_only_bad_values(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": "x"}',), ('{"k": null}',), ('{}',)], "j string")
    spec = FieldSpec("k", "$.k", "int", "try")
    got = [r[0] for r in df.select(cast_failures(parse_payload("j"), spec)).collect()]
    assert got == [0, 1, 0, 0]


def test_strip_markup_keeps_entities(spark):
    df = spark.createDataFrame([("<p>Hi <b>you</b>&nbsp;</p>",)], "h string")
    assert df.select(strip_markup("h")).first()[0] == "Hi  you &nbsp;"


def test_path_levels_short_path_gives_null(spark):
    df = spark.createDataFrame([("a\\b",)], "p string")
    r = with_path_levels(df, "p", "lvl", 3, last_col="last").first()
    assert (r.lvl_1, r.lvl_2, r.lvl_3, r.last) == ("a", "b", None, "b")


def test_comma_list(spark):
    df = spark.createDataFrame([(" a, b,,c ",)], "s string")
    assert df.select(comma_list("s")).first()[0] == ["a", "b", "c"]


HARD_VALUES = [
    "null", "1", "-7", "3.7", "1e3", "2147483648", "-2147483649", "99999999999999999999", '"12"', '" 5 "', '"3.5"',
    '"abc"', "true", '{"a":1}', "[1,2]", '"2024-03-01T10:00:00.123-0300"', '"2024-03-01"', '"2024-3-1"', '"2024"',
    "2024", "1700000000", "1.2E-5", '"12:30:00"', '"10000-01-01"', '"+2024-01-01"', '""', '"-"', '"2024-13-01"']


@pytest.mark.parametrize("type_", ["string", "int", "timestamp", "boolean", "array<variant>", "array<string>"])
def test_one_walk_reads_what_the_paths_read(spark, type_):
    texts = [t for v in HARD_VALUES for t in ('{"fields":{"System.X":%s,"o":{"n":%s},"z":"k"}}' % (v, v),
                                              '{"fields":%s}' % v, v, '{"fields":{"o":%s}}' % v)]
    specs = [FieldSpec("x", '$.fields["System.X"]', type_, "try"), FieldSpec("n", "$.fields.o.n", type_, "try"),
             FieldSpec("z", "$.fields.z", "string", "try")]
    df = spark.createDataFrame([(t,) for t in [*texts, "{}", "{", None]], "j string").withColumn(
        "v", parse_payload("j", lenient=True)).withColumn("r", fields_read("v", specs))
    rows = df.select("j", *[F.to_json(F.struct(c)).alias(f"{k}_{s.name}") for s in specs for k, c in
                            (("walk", field_of("r", "v", s)), ("path", field_col("v", s)))]).collect()
    assert all(r[f"walk_{s.name}"] == r[f"path_{s.name}"] for r in rows for s in specs)
    assert any(r.walk_x != "{}" for r in rows)


def test_one_walk_raises_where_the_path_does(spark):
    for value, type_ in (('"x"', "int"), ("2147483648", "int"), ('"x"', "timestamp"), ("5", "array<variant>")):
        spec = FieldSpec("p", "$.p", type_)
        df = spark.createDataFrame([('{"p": %s}' % value,)], "j string").withColumn("v", parse_payload("j"))
        with pytest.raises(PySparkException):
            df.withColumn("r", fields_read("v", [spec])).select(field_of("r", "v", spec)).collect()


def test_only_paths_of_keys_that_do_not_cross_are_walked():
    specs = [FieldSpec("a", "$.f.a"), FieldSpec("b", "$.f.a.b"), FieldSpec("c", "$.f.c[0]"), FieldSpec("d", '$.f["d.e"]')]
    assert walkable(specs) == [specs[3]]


@pytest.mark.parametrize("mode", ["strict", "try"])
def test_whole_numbers_as_text(spark, mode):
    """Numbers read as text without a cast planned for each of them; every other value as by its path."""
    values = ["7", "-12", "9223372036854775807", "92233720368547758070", "1.50", "1e3", '"007"', '"a"', "null", "true",
              '{"b":1}', "[1,2]"]
    rows = [(i, '{"a":{"n":%s}}' % v) for i, v in enumerate(values)] + [(-1, '{"a":{}}'), (-2, "{}"), (-3, None)]
    spec = FieldSpec("n", "$.a.n", mode=mode, whole=True)
    df = spark.createDataFrame(rows, "i int, raw string").select("i", parse_payload("raw").alias("v"))
    got = df.withColumn("_read", fields_read("v", [spec])).select(
        "i", field_of("_read", "v", spec), field_col("v", FieldSpec("by_path", "$.a.n", mode=mode)))
    assert got.where(~F.col("n").eqNullSafe(F.col("by_path"))).count() == 0
    assert {r.n for r in got.where("i in (0, 1, 2)").collect()} == {"7", "-12", "9223372036854775807"}
