import datetime as dt

from pyspark.sql import functions as F

from deliverylens.functions.timefmt import utc_to_local_wall_clock
from deliverylens.session import scratch_path
from deliverylens.sources import incremental as inc

SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string"


def _rows(spark):
    t = dt.datetime(2024, 1, 15, 0, 0)
    return spark.createDataFrame([(1, t - dt.timedelta(minutes=1), "a"), (5, t, "a"), (9, t, "b"),
                                  (3, t + dt.timedelta(minutes=1), "b")], SCHEMA)


def test_and_both_loses_edit_to_known_id_keyset_does_not(spark):
    start = {"last_update_timestamp": "2024-01-15T00:00:00Z", "last_work_item_id": 5}
    df = _rows(spark)
    both = sorted(r.event_id for r in inc.slice_compound(df, start, mode="and_both").collect())
    keyset = sorted(r.event_id for r in inc.slice_compound(df, start, mode="keyset").collect())
    assert both == [9]          # id 3 changed later but has a smaller id: lost
    assert keyset == [3, 9]


def test_time_slice_is_inclusive_and_bounded_is_half_open(spark):
    df = _rows(spark)
    assert sorted(r.event_id for r in inc.slice_time(df, "2024-01-15 00:00").collect()) == [3, 5, 9]
    assert sorted(r.event_id for r in inc.slice_bounded(df, "2024-01-15 00:00", "2024-01-15 00:01").collect()) == [5, 9]


def test_next_offset_empty_read_keeps_start(spark):
    start = {"last_update_timestamp": "2030-01-01T00:00:00Z", "last_work_item_id": 4}
    empty = inc.slice_compound(_rows(spark), start)
    r = inc.next_offset(empty, start).first()
    assert (r.last_update_timestamp, r.last_work_item_id, r.rows_read) == ("2030-01-01T00:00:00Z", 4, 0)


def test_project_option():
    assert inc.project_names(None) is None
    assert inc.project_names(" * ") is None
    assert inc.project_names("all") is None
    assert inc.project_names(" a, b ,,c") == ["a", "b", "c"]


def test_local_wall_clock_is_ambiguous_on_clock_change(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 10, 27, 0, 30),), (dt.datetime(2024, 10, 27, 1, 30),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(utc_to_local_wall_clock("ts", "Europe/Berlin")).collect()]
    assert got == ["2024-10-27 02:30", "2024-10-27 02:30"]


def test_an_id_listed_twice_has_its_body_once(spark):
    listed = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, 3, 4)], "id long")
    chunks = inc.id_chunks(listed, "id", 3, scratch_path(spark, "twice"))
    bodies = spark.createDataFrame([(i, f"body {i}") for i in range(6)], "id long, body string")
    got = sorted((r.id, r.chunk_id) for r in inc.chunk_bodies(chunks, bodies, "id").collect())
    assert got == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_id_chunks_match_consecutive_ranks(spark):
    ids = spark.range(0, 2000, 3).withColumnRenamed("id", "k").repartition(5)
    out = inc.id_chunks(ids, "k", 200, scratch_path(spark, "chunks"))
    got = {r.k: r.chunk_id for r in out.collect()}
    want = {k: i // 200 for i, k in enumerate(range(0, 2000, 3))}
    assert got == want


def test_safe_local_start_moves_back_in_the_repeated_hour(spark):
    from deliverylens.functions.timefmt import safe_local_start
    rows = [(dt.datetime(2024, 10, 27, 0, 30),), (dt.datetime(2024, 10, 27, 1, 30),),
            (dt.datetime(2024, 10, 27, 3, 0),), (dt.datetime(2024, 3, 31, 1, 30),), (dt.datetime(2024, 1, 15, 12, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(safe_local_start("ts", "Europe/Berlin")).collect()]
    # 00:30 and 01:30 UTC both read 02:30 locally: start from the earlier reading
    assert got == ["2024-10-27 01:30", "2024-10-27 02:30", "2024-10-27 04:00", "2024-03-31 03:30",
                   "2024-01-15 13:00"]
