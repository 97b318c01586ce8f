"""A key, release or group of copies holding a third of all rows: results
stay exact (checked against plain Python) and nothing is dropped."""
import random

from pyspark.sql import functions as F

from deliverylens.operators import gold
from deliverylens.operators.scd import latest_per_key


def test_latest_per_key_with_hot_key_and_copies(spark):
    rnd = random.Random(3)
    rows = []
    for n in range(3000):
        key = "hot" if n % 3 == 0 else f"k{n % 200}"
        rows.append((key, rnd.randint(0, 10_000), n))
    rows += [("hot", 10_001, 999_999)] * 500  # exact copies of the winning change
    df = spark.createDataFrame(rows, "k string, seq int, n int").repartition(8)
    want = {}
    for k, seq, n in rows:
        if k not in want or (seq, n) > want[k]:
            want[k] = (seq, n)
    for m in ("max_by", "row_number"):
        got = {r.k: (r.seq, r.n) for r in latest_per_key(df, ["k"], ["seq", "n"], method=m).collect()}
        assert got == want


def test_rollup_with_hot_release(spark):
    rows = [(f"J{n}", "Backlog" if n % 2 else "Done", n % 7 or None,
             ["HOT"] if n % 3 == 0 else [f"R{n % 5}"], ["Hot release"] if n % 3 == 0 else [None],
             None, None, None) for n in range(3000)]
    df = spark.createDataFrame(rows, "jira_id string, jira_status string, jira_story_points int, "
                                     "release_ids array<string>, jira_fix_versions array<string>, "
                                     "ado_story_id string, ado_story_points int, ado_board_column string")
    out = {r.release_id: r for r in gold.release_rollup(df.repartition(8), order=False).collect()}
    hot = [r for r in rows if r[3] == ["HOT"]]
    assert out["HOT"].total_work == len(hot)
    assert out["HOT"].story_point_total == float(sum(r[2] or 0 for r in hot))
    assert out["HOT"].done == sum(1 for r in hot if r[1] == "Done")
    assert sum(r.total_work for r in out.values()) == len(rows)


def test_mapping_keeps_every_row_of_a_hot_issue(spark):
    issues = spark.createDataFrame([("HOT",), (" COLD ",), ("NONE",)], "jira_id string")
    stories = spark.createDataFrame([(f"s{n}", "HOT" if n % 3 else "COLD", "New") for n in range(3000)],
                                    "id string, client_id string, state string")
    for strategy in gold.STRATEGIES:
        got = gold.map_items(issues, stories, strategy=strategy, columns=["jira_id", "ado_story_id"])
        counts = {r.jira_id: (r.n, r.rows) for r in got.groupBy("jira_id").agg(
            F.count("ado_story_id").alias("n"), F.count(F.lit(1)).alias("rows")).collect()}
        assert counts == {"HOT": (2000, 2000), " COLD ": (1000, 1000), "NONE": (0, 1)}


def test_id_chunks_with_a_hot_id_value(spark):
    from deliverylens.session import scratch_path
    from deliverylens.sources import incremental as inc

    ids = [7] * 1000 + list(range(2000))  # one id value holds a third of the rows
    df = spark.createDataFrame([(i,) for i in ids], "k bigint").repartition(4)
    out = inc.id_chunks(df, "k", 200, scratch_path(spark, "chunks"))
    got = {}
    for r in out.collect():
        got.setdefault(r.chunk_id, []).append(r.k)
    want = sorted(ids)
    assert sorted(got) == list(range(len(want) // 200))
    for c, members in got.items():
        assert sorted(members) == want[c * 200:(c + 1) * 200]
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1
