"""Plan-shape checks for the properties the design relies on at scale."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from deliverylens.operators import gold
from deliverylens.operators.scd import latest_per_key
from deliverylens.plans import catalogue


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lineitem(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


def test_max_by_is_reduced_before_the_shuffle(spark):
    df = latest_per_key(_lineitem(spark), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"], method="max_by")
    plan = _plan(df)
    assert "partial_max_by" in plan
    # the partial aggregate sits below (after, in the text) the exchange
    assert plan.index("Exchange") < plan.index("partial_max_by")


def test_row_number_gets_a_partial_group_limit(spark):
    df = latest_per_key(_lineitem(spark), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"],
                        method="row_number")
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_rollup_aggregates_partially(spark):
    df = spark.createDataFrame([("A", "Backlog", 1, ["V1"], ["R1"], "s", 2, "Done")],
                               "jira_id string, jira_status string, jira_story_points int, release_ids array<string>, "
                               "jira_fix_versions array<string>, ado_story_id string, ado_story_points int, "
                               "ado_board_column string")
    plan = _plan(gold.release_rollup(df, order=False))
    assert plan.count("HashAggregate") >= 2 and "partial_count" in plan


def test_slices_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = _plan(catalogue.slice_keyset(spark, SF_SMALL))
    assert "PushedFilters: [Or(GreaterThan(ts," in plan
    plan = _plan(catalogue.type_filter_slice(spark, SF_SMALL))
    assert "EqualTo(event_type,purchase)" in plan


def test_anti_branch_uses_reduced_key_set(spark):
    i = spark.createDataFrame([("A", "x")], "jira_id string, jira_name string")
    s = spark.createDataFrame([("s", "A", "New")], "id string, client_id string, state string")
    plan = _plan(gold.unmatched_items(i, s))
    assert "LeftAnti" in plan and plan.count("HashAggregate") >= 2


def test_gold_reads_only_needed_columns(spark):
    iss, sto = catalogue.refresh.current_tables(spark, SF_SMALL, catalogue.AS_OF, gold.ROLLUP_INPUT)
    assert set(sto.columns) <= {"board_column", "changed_date", "client_id", "extraction_timestamp", "id", "rev",
                                "state", "story_points"}
    assert "fix_versions" in iss.columns and "reporter" not in iss.columns
    assert F is not None
