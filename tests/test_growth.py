"""What the batch refresh holds, shuffles and stores stays in proportion when the feeds grow."""
import glob
import json
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from deliverylens.operators import gold
from deliverylens.plans import catalogue, refresh
from deliverylens.session import scratch_path
from deliverylens.sources import parts, tables, versions
from deliverylens.streaming.flows import export_change_files, file_stream, to_bronze


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pruned_variant_tables_are_not_broadcast(spark):
    """Without its VARIANT column a table of issues seems far smaller than it is; the driver would collect it."""
    issues, stories = refresh.current_tables(spark, SF_SMALL, catalogue.AS_OF, gold.ROLLUP_INPUT)
    for strategy in gold.STRATEGIES:
        m = gold.map_items(issues, stories, strategy=strategy, columns=gold.ROLLUP_INPUT)
        m = m.select("jira_status", "ado_board_column")
        assert "Broadcast" not in _plan(m)
        assert m.count() > 0
    assert "Broadcast" not in _plan(gold.unmatched_items(issues, stories).select("jira_id"))


def test_payloads_are_built_by_tasks_of_bounded_rows(spark, monkeypatch):
    n_orders, n_lines = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in ("orders", "lineitem"))
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 100)
    for build, n in ((tables.client_issues_bronze, n_orders), (tables.internal_stories_bronze, n_lines)):
        sizes = [len(p) for p in build(spark, SF_SMALL).select("raw_data").rdd.glom().collect()]
        assert sum(sizes) == n
        assert max(sizes) < 200


def test_derived_columns_are_not_shuffled(spark):
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, "200")
    try:
        plan = _plan(refresh.current_stories(spark, SF_SMALL, catalogue.AS_OF))
    finally:
        spark.conf.set(fields, before)
    shuffle = plan.index("Exchange hashpartitioning(id")
    assert "regexp_replace" in plan[:shuffle] and "regexp_replace" not in plan[shuffle:]
    assert "variant_get" not in plan[:shuffle]


def test_tables_on_the_way_are_packed(spark):
    kept = scratch_path(spark, "exported")
    export_change_files(spark.range(10), kept, "id", by_range=False)
    assert glob.glob(f"{kept}/*.zstd.parquet")
    table = refresh.materialise(spark, spark.range(10), "packed")
    assert all(f.endswith(".zstd.parquet") for f in table.inputFiles())


def test_payload_stages_are_compiled(spark):
    """Methods of more than 8000 bytes are interpreted by the JVM."""
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    for build in (tables.client_issues_bronze, tables.internal_stories_bronze):
        build(spark, SF_SMALL)
        assert int(spark.conf.get(key)) <= 8000
        spark.conf.unset(key)
    spark.conf.set(key, "5000")
    tables.client_issues_bronze(spark, SF_SMALL)
    assert spark.conf.get(key) == "5000"
    spark.conf.unset(key)


def test_a_payload_is_walked_once(spark):
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, "200")
    try:
        plan = _plan(refresh.current_stories(spark, SF_SMALL, catalogue.AS_OF).select("id", "title", "state", "tags"))
    finally:
        spark.conf.set(fields, before)
    assert plan.count("try_variant_get(") == 1


def test_issue_changes_come_from_one_reading(spark):
    """The earlier change of an issue is a second row of its order, not a second reading of the orders."""
    feed = tables.client_issues_bronze(spark, SF_SMALL, as_of=catalogue.AS_OF, changes=True)
    assert _plan(feed).count("orders.parquet") == 1
    columns = ["jira_internal_id", "updated", "raw_data"]
    every, once = (Counter(map(tuple, df.select(*columns).collect()))
                   for df in (feed, tables.client_issues_bronze(spark, SF_SMALL, as_of=catalogue.AS_OF)))
    assert not once - every
    earlier = every - once
    assert sorted(int(r[0]) for r in earlier.elements()) == sorted(int(r[0]) for r in once.elements() if int(r[0]) % 5 == 2)
    assert earlier and all(json.loads(r[2])["fields"]["status"]["name"] == "Backlog" for r in earlier)


def _rows(df) -> Counter:
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_written_tables_leave_no_shuffle_behind(spark):
    before = _shuffle_files(spark)
    made = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = refresh.materialise(spark, made, "seven")
    for _ in range(100):  # the files go in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert table.count() == 7


def test_current_stories_come_in_parts(spark, monkeypatch):
    whole = _rows(refresh.current_stories(spark, SF_SMALL, catalogue.AS_OF).drop("raw_data"))
    monkeypatch.setattr(parts, "ROWS_PER_PART", 2000)
    every = tables.story_parts(spark, SF_SMALL)
    assert len(every) > 2
    sizes = [refresh.current_stories(spark, SF_SMALL, catalogue.AS_OF, part=p, columns=["id"]).count() for p in every]
    assert sum(sizes) == whole.total() and max(sizes) < 1.2 * 2000
    assert _rows(catalogue.silver_stories_current(spark, SF_SMALL)) == whole


def test_stored_payloads_come_in_parts(spark, monkeypatch):
    whole = _rows(catalogue.stored_variant_paths(spark, SF_SMALL))
    monkeypatch.setattr(parts, "ROWS_PER_PART", 4000)
    seen = _written_sizes(monkeypatch)
    assert _rows(catalogue.stored_variant_paths(spark, SF_SMALL)) == whole
    assert len(seen) == 1 and seen[0] > 1


def _written_sizes(monkeypatch) -> list[int]:
    """How many parts each table that is written from now on comes in."""
    seen, write = [], refresh.written

    def counted(spark, parts, *args, **kwargs):
        every = list(parts)
        seen.append(len(every))
        return write(spark, every, *args, **kwargs)

    monkeypatch.setattr(refresh, "written", counted)
    return seen


ISSUES = [("A", 1), (" A ", 2), (None, 3), (None, 4), ("B", 5), ("C", 6), ("D", 7), ("D", 7)]
STORIES = [("s1", "A", "New"), ("s2", " A", "Closed"), ("s2", " A", "Closed"), ("s3", "A ", None), ("s4", None, "New"),
           ("s5", "B", "Removed"), ("s6", "C", "Active"), (None, "D", "New"), ("s7", "Z", "New")]


def _tables(spark):
    """Issues and stories with odd keys, every other column empty."""
    i = spark.createDataFrame(ISSUES, "jira_id string, story_points int")
    s = spark.createDataFrame(STORIES, "id string, client_id string, state string")
    issue_types = dict(f.split(" ")[:2] for f in (
        "fix_versions array<variant>", "fix_version_ids array<string>", "labels array<string>", "is_closed boolean",
        "created_date timestamp", "updated_date timestamp"))
    story_types = dict(f.split(" ") for f in ("rev int", "story_points int", "priority int", "is_closed boolean",
                                              "board_column_done boolean"))
    empty = lambda df, names, types: df.select("*", *[
        F.lit(None).cast(types.get(c, "string")).alias(c) for c in names if c not in df.columns])
    names = [src or "fix_versions" for _, src in gold.ISSUE_SIDE]
    return (empty(i, names, issue_types), empty(s, [src for _, src in gold.STORY_SIDE], story_types))


def test_mapping_in_parts_is_the_mapping(spark, monkeypatch):
    issues, stories = _tables(spark)
    for options in ({}, {"strategy": "left_join"}, {"keep_null_state": True}):
        whole = _rows(gold.map_items(issues, stories, **options))
        with monkeypatch.context() as m:
            m.setattr(parts, "ROWS_PER_PART", 4)
            assert _rows(refresh.map_by_parts(issues, stories, **options)) == whole


def test_mapped_items_come_in_parts(spark, monkeypatch):
    queries = (catalogue.mapped_items, catalogue.mapped_items_left_join, catalogue.mapped_items_keep_null_state)
    whole = [_rows(q(spark, SF_SMALL)) for q in queries]
    monkeypatch.setattr(parts, "ROWS_PER_PART", 3000)
    for query, rows in zip(queries, whole):
        with monkeypatch.context() as m:
            seen = _written_sizes(m)
            assert _rows(query(spark, SF_SMALL)) == rows
            assert len(seen) == 3 and seen[1] > 1 and seen[2] > 1


def test_gold_is_written_in_parts(spark, monkeypatch):
    issues, stories = _tables(spark)
    issues = issues.where("jira_id is not null")
    found, published = [], versions.publish
    monkeypatch.setattr(versions, "publish", lambda df, root: (found.append(df), published(df, root))[1])
    for size in (1000, 4):
        with monkeypatch.context() as m:
            m.setattr(parts, "ROWS_PER_PART", size)
            out = scratch_path(spark, "gold-parts")
            warn = refresh.write_gold(issues, stories, out, as_of=catalogue.AS_OF)
            runs = refresh.rule_runs(spark, out).select("view", "version", "rule", "rows", "broken", "outcome")
            found.append((warn.get, _rows(refresh.read_gold(spark, out, "mapped_items")), _rows(runs)))
    assert len(found[0]) == 1 and len(found[3]) > 1
    assert found[2] == found[5]


def test_a_version_in_parts_counts_once_whole(spark):
    root = scratch_path(spark, "parted")
    versions.publish([spark.range(3), spark.range(3, 5)], root)
    bad = spark.range(1).select(F.raise_error(F.lit("stopped")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stopped"):
        versions.publish([spark.range(7), bad], root)
    assert versions.current(spark, root).count() == 5
    versions.publish(spark.range(2), root)
    assert versions.current(spark, root).count() == 2 and len(versions.numbers(spark, root, whole=False)) == 1


def test_refresh_takes_feeds_in_by_parts(spark, monkeypatch):
    from deliverylens.plans import streams

    whole = _rows(streams.end_to_end_refresh(spark, SF_SMALL))
    exported, export = [], streams.export_change_files
    monkeypatch.setattr(streams, "export_change_files", lambda df, path, *a, **k: (exported.append(path), export(df, path, *a, **k)))
    monkeypatch.setattr(parts, "ROWS_PER_PART", 4000)
    assert _rows(streams.end_to_end_refresh(spark, SF_SMALL)) == whole
    assert len(exported) > 2 and len(set(exported)) == 2


def test_bronze_is_packed_tighter_than_pages(spark):
    pages, bronze = scratch_path(spark, "pages"), scratch_path(spark, "bronze")
    feed = tables.internal_stories_bronze(spark, SF_SMALL, as_of=catalogue.AS_OF).drop("extraction_timestamp").coalesce(1)
    export_change_files(feed, pages, "id", by_range=False)
    to_bronze(file_stream(spark, pages, feed.schema), bronze, scratch_path(spark, "ck-packed"))
    size = {path: sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")) for path in (pages, bronze)}
    assert size[bronze] < 0.95 * size[pages]
    assert _rows(spark.read.parquet(bronze).drop("extraction_timestamp")) == _rows(feed)
    assert spark.conf.get("parquet.compression.codec.zstd.level", None) is None
