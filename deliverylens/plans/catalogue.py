"""Query catalogue: one callable per operator group, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or data Spark derives from them) in
full. Array columns are rendered as ``a|b|NULL`` text in the catalogue so
results compare across engines; the library functions themselves return real
arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import FieldSpec, cast_failures, field_col, parse_payload, strip_markup, with_path_levels
from ..functions.states import unified_state_col
from ..functions.timefmt import safe_local_start, utc_to_local_wall_clock
from ..operators import gold, quality
from ..operators.scd import latest_per_key
from ..operators.silver import parse_issues, parse_stories
from ..session import scratch_path
from ..sources import incremental as inc
from ..sources.tables import (area_paths, client_issues_bronze, internal_stories_bronze, read_table, spread,
                              story_parts)
from . import refresh

# Fixed parameters of the catalogue queries (offsets, zone, options).
AS_OF = "2026-01-01 00:00:00"
TIME_START = "2024-01-15 00:00"
COMPOUND_START = {"last_update_timestamp": "2024-01-15T00:00:00Z", "last_work_item_id": 7000}
BOUNDED = ("2024-01-10 00:00", "2024-01-20 00:00")
LOCAL_ZONE = "Europe/Berlin"
PROJECT_OPTION = " view, click ,, purchase "
TYPE_FILTER = "purchase"
CHUNK_SIZE = 200
EVENT_KEYS = ["user_id"]
EVENT_SEQUENCE = ["ts", "event_id"]
NULL_MARK = "NULL"


def array_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit(NULL_MARK))), "|")


def _arrays_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: array_text(f.name) for f in df.schema.fields
                           if f.dataType.typeName() == "array"})


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


# ----------------------------------------------------------------- gold -----

def releases_rollup(spark, sf):
    return refresh.releases(spark, sf, as_of=AS_OF)


def mapped_items(spark, sf):
    return _arrays_as_text(refresh.mapped(spark, sf, AS_OF))


def mapped_items_left_join(spark, sf):
    return _arrays_as_text(refresh.mapped(spark, sf, AS_OF, strategy="left_join"))


def mapped_items_keep_null_state(spark, sf):
    return _arrays_as_text(refresh.mapped(spark, sf, AS_OF, keep_null_state=True))


def unmatched_items(spark, sf):
    issues, stories = refresh.current_tables(spark, sf, AS_OF, ["jira_id", "jira_name", "jira_status",
                                                                 "jira_story_points"])
    return gold.unmatched_items(issues, stories).select("jira_id", "jira_name", "status", "story_points")


def unified_state_counts(spark, sf):
    m = refresh.mapped(spark, sf, AS_OF, columns=gold.ROLLUP_INPUT)
    return (m.withColumn("unified_state", unified_state_col("ado_board_column", "jira_status"))
            .groupBy("unified_state").agg(F.count(F.lit(1)).alias("n")))


def effective_points(spark, sf):
    m = gold.effective_points(refresh.mapped(spark, sf, AS_OF, columns=gold.ROLLUP_INPUT))
    return m.select("jira_id", "ado_story_id", "jira_story_points", "ado_story_points", "effective_story_points")


def release_explode(spark, sf):
    e = gold.explode_releases(refresh.mapped(spark, sf, AS_OF, columns=gold.ROLLUP_INPUT))
    return e.select("jira_id", "ado_story_id", "release_id", "release_name")


def release_explode_outer(spark, sf):
    e = gold.explode_releases(refresh.mapped(spark, sf, AS_OF, columns=gold.ROLLUP_INPUT), outer=True)
    return e.select("jira_id", "ado_story_id", "release_id", "release_name")


def release_state_long(spark, sf):
    e = gold.explode_releases(refresh.mapped(spark, sf, AS_OF, columns=gold.ROLLUP_INPUT))
    e = e.withColumn("unified_state", unified_state_col("ado_board_column", "jira_status"))
    return e.groupBy("release_id", "release_name", "unified_state").agg(F.count("jira_id").alias("n"))


def release_conservation(spark, sf):
    r = refresh.releases(spark, sf, as_of=AS_OF, order=False)
    state_sum = sum((F.col(s) for s in gold.UNIFIED_STATES), F.lit(0).cast("bigint"))
    return r.select("release_id", "release_name", "total_work", state_sum.alias("state_sum"),
                    gold.RELEASE_FAIL_RULE.column().alias("balanced"))


def quality_warn_counts(spark, sf):
    m = refresh.mapped(spark, sf, AS_OF, columns=["jira_id", "ado_story_id"])
    rules = [gold.MAPPING_WARN_RULE, quality.Rule("jira_id is not null", "jira_id IS NOT NULL")]
    counts = quality.rule_counts(m, rules)
    return counts.select(F.col(f"`{rules[0].name}`").alias("missing_internal_story"),
                         F.col(f"`{rules[1].name}`").alias("null_jira_id"))


def enforced_releases(spark, sf):
    r = refresh.releases(spark, sf, as_of=AS_OF, order=False)
    r = quality.with_fail_rules(r, [gold.RELEASE_FAIL_RULE])
    return quality.enforce_schema(r, gold.RELEASES_DDL).orderBy(F.col("release_name").asc_nulls_first())


# ------------------------------------------------------------------ scd -----

def scd1_lineitem_max_by(spark, sf):
    from ..sources.tables import latest_lines
    return latest_lines(read_table(spark, sf, "lineitem"), method="max_by")


def scd1_lineitem_row_number(spark, sf):
    from ..sources.tables import latest_lines
    return latest_lines(read_table(spark, sf, "lineitem"), method="row_number")


def scd1_ties(spark, sf):
    """A sequence with ties, settled by further columns of the row."""
    return latest_per_key(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
                          tie_break=F.struct("l_partkey", "l_suppkey", "l_extendedprice"))


def scd1_events_latest(spark, sf):
    return latest_per_key(_events(spark, sf), EVENT_KEYS, EVENT_SEQUENCE)


# ---------------------------------------------------------- incremental -----

def slice_time_inclusive(spark, sf):
    return inc.slice_time(_events(spark, sf), TIME_START)


def slice_and_both(spark, sf):
    return inc.slice_compound(_events(spark, sf), COMPOUND_START, mode="and_both")


def slice_keyset(spark, sf):
    return inc.slice_compound(_events(spark, sf), COMPOUND_START, mode="keyset")


def slice_bounded(spark, sf):
    return inc.slice_bounded(_events(spark, sf), *BOUNDED)


def next_offset(spark, sf):
    read = inc.slice_compound(_events(spark, sf), COMPOUND_START, mode="keyset")
    return inc.next_offset(read, COMPOUND_START, group_cols=["event_type"])


def next_offset_minute(spark, sf):
    read = inc.slice_time(_events(spark, sf), TIME_START)
    return inc.next_offset(read, {"last_update_timestamp": TIME_START}, minute=True)


def slice_local_zone(spark, sf):
    e = inc.slice_time(_events(spark, sf), TIME_START)
    return e.select("event_id", "ts", utc_to_local_wall_clock("ts", LOCAL_ZONE).alias("local_minute"))


def slice_local_zone_safe(spark, sf):
    e = inc.slice_time(_events(spark, sf), TIME_START)
    return e.select("event_id", "ts", safe_local_start("ts", LOCAL_ZONE).alias("safe_local_minute"))


def local_zone_clock_change(spark, sf):
    """The feed moved into the autumn, so that it runs over the hour that the zone repeats."""
    e = _events(spark, sf).withColumn("ts", F.expr("ts + INTERVAL 285 DAYS"))
    return e.select("event_id", "ts", utc_to_local_wall_clock("ts", LOCAL_ZONE).alias("local_minute"),
                    safe_local_start("ts", LOCAL_ZONE).alias("safe_local_minute"))


def project_list_filter(spark, sf):
    e = inc.project_filter(_events(spark, sf), PROJECT_OPTION, "event_type")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("max_event_id"))


def type_filter_slice(spark, sf):
    e = inc.slice_time(_events(spark, sf), TIME_START).filter(F.col("event_type") == TYPE_FILTER)
    return e.select("event_id", "ts", "user_id", "value").orderBy("ts", "event_id")


def id_chunks(spark, sf):
    ids = read_table(spark, sf, "orders").select("o_orderkey")
    chunks = inc.id_chunks(ids, "o_orderkey", CHUNK_SIZE, scratch_path(spark, "id-chunks"))
    return chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_ids"), F.min("o_orderkey").alias("first_id"),
                                         F.max("o_orderkey").alias("last_id"))


def id_chunk_bodies(spark, sf):
    """Ids listed first, then read in chunks: number, worth and latest date of each chunk's bodies."""
    orders = read_table(spark, sf, "orders")
    chunks = inc.id_chunks(orders.select("o_orderkey"), "o_orderkey", CHUNK_SIZE, scratch_path(spark, "id-chunks"))
    bodies = inc.chunk_bodies(chunks, orders.select("o_orderkey", "o_totalprice", "o_orderdate"), "o_orderkey")
    return bodies.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n_bodies"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"),
        F.max("o_orderdate").alias("last_date"))


def project_listing(spark, sf):
    return inc.list_projects(_events(spark, sf), "event_type").orderBy("event_type")


# --------------------------------------------------------------- payload -----

def envelope_json(spark, sf):
    b = client_issues_bronze(spark, sf, as_of=AS_OF)
    return b.select(
        "jira_internal_id", "project", "key", "summary", "issue_type", "updated", "url", "extraction_timestamp",
        F.get_json_object("raw_data", "$.key").alias("payload_key"),
        F.get_json_object("raw_data", "$.fields.status.name").alias("payload_status"),
        F.get_json_object("raw_data", "$.fields.customfield_10022").alias("payload_points"),
    )


def ingest_stamp(spark, sf):
    e = _events(spark, sf)
    return e.select("event_id", "user_id", "event_type",
                    F.to_timestamp(F.lit(AS_OF)).alias("extraction_timestamp"))


def variant_extract_typed(spark, sf):
    e = spread(_events(spark, sf)).withColumn("v", parse_payload("props"))
    return e.select("event_id",
                    field_col("v", FieldSpec("k", "$.k", "int")),
                    field_col("v", FieldSpec("k_text", "$.k", "string")),
                    field_col("v", FieldSpec("k_double", "$.k", "double")),
                    field_col("v", FieldSpec("missing", "$.nope", "string")))


def variant_arrays(spark, sf):
    p = parse_issues(client_issues_bronze(spark, sf, as_of=AS_OF))
    return p.select("jira_id",
                    array_text("fix_version_ids").alias("fix_version_ids"),
                    array_text(F.transform("fix_versions", lambda x: F.variant_get(x, "$.name", "string")))
                    .alias("fix_version_names"),
                    array_text("labels").alias("labels"),
                    F.size("fix_versions").alias("n_versions"),
                    "story_points", "created_date", "is_closed", "has_parent")


def variant_dotted_path(spark, sf):
    columns = ["id", "rev", "state", "board_column", "story_points", "client_id", "changed_date", "priority",
               "parent_id", "work_item_type"]
    s = parse_stories(internal_stories_bronze(spark, sf, as_of=AS_OF), keep_payload=False, wanted=columns)
    return s.select(*columns)


def damaged_props(events: DataFrame) -> Column:
    """Fixture damage, in this order: every 50th id cut before its closing
    brace, every 70th a text value, every 90th a JSON null."""
    eid = F.col("event_id")
    return (F.when(eid % 50 == 0, F.expr("substring(props, 1, length(props) - 1)"))
            .when(eid % 70 == 0, F.lit('{"k":"x"}'))
            .when(eid % 90 == 0, F.lit('{"k":null}'))
            .otherwise(F.col("props")))


def variant_lenient(spark, sf):
    e = spread(_events(spark, sf))
    e = e.withColumn("props", damaged_props(e)).withColumn("v", parse_payload("props", lenient=True))
    spec = FieldSpec("k", "$.k", "int", mode="try")
    return e.select("event_id", F.col("v").isNotNull().alias("parsed"), field_col("v", spec),
                    cast_failures("v", spec).alias("cast_failed"))


def strip_markup_pages(spark, sf):
    p = spread(read_table(spark, sf, "pages"))
    text = strip_markup("html")
    return p.select("page_id", text.alias("text"), F.length(text).alias("n_chars"))


def path_levels(spark, sf):
    return with_path_levels(area_paths(spark, sf), "area_path", "area_level", 3, last_col="client")


def closed_parent_tag_flags(spark, sf):
    s = refresh.current_stories(spark, sf, AS_OF, columns=refresh.GOLD_STORY_COLUMNS + ["has_parent", "has_tags"])
    return s.select("id", "state", "is_closed", "has_parent", "has_tags", "tags")


def releases_latest_name(spark, sf):
    """Options: one row per release id with its greatest name, plus a count
    of distinct issues next to the fanned-out item count."""
    return refresh.releases(spark, sf, as_of=AS_OF, order=False, latest_name=True, distinct_items=True)


def silver_issues_current(spark, sf):
    cur = refresh.current_issues(spark, sf, AS_OF)
    cur = cur.withColumn("fix_versions", F.transform("fix_versions", lambda x: F.variant_get(x, "$.name", "string")))
    return _arrays_as_text(cur)


def silver_stories_current(spark, sf):
    return refresh.stories_by_parts(spark, sf, AS_OF, drop=("raw_data",))


def stored_variant_paths(spark, sf):
    """Current stories stored with their parsed payload (VARIANT) and read
    back: the path reads are pushed into the Parquet scan, which reads only
    those paths of the stored VARIANT."""
    each = (refresh.current_stories(spark, sf, AS_OF, part=p) for p in story_parts(spark, sf))
    cur, _ = refresh.written(spark, each, "stories-payload")
    v = F.col("raw_data")
    return cur.select("id",
                      F.variant_get(v, '$.fields["System.State"]', "string").alias("payload_state"),
                      F.variant_get(v, '$.fields["Custom.Client_ID"]', "string").alias("payload_client_id"),
                      F.variant_get(v, "$.rev", "int").alias("payload_rev"))


def gold_views_written(spark, sf):
    out = scratch_path(spark, "gold")
    refresh.write_gold(*refresh.current_tables(spark, sf, AS_OF), out, as_of=AS_OF)
    return refresh.read_gold(spark, out, "releases")


def quality_rule_runs(spark, sf):
    out = scratch_path(spark, "gold-rules")
    refresh.write_gold(*refresh.current_tables(spark, sf, AS_OF), out, as_of=AS_OF)
    return refresh.rule_runs(spark, out).select("view", "version", "rule", "action", "rows", "broken", "outcome")


def releases_update_time(spark, sf):
    """``last_update`` of a roll-up without a stated time is the time of its run."""
    begun = datetime.now(timezone.utc).replace(microsecond=0)
    rel = gold.release_rollup(refresh.mapped(spark, sf, AS_OF, columns=refresh.ROLLUP_INPUT), order=False)
    rel = refresh.materialise(spark, rel, "releases-now")
    return rel.agg(F.count(F.lit(1)).alias("n_releases"), F.count_distinct("last_update").alias("n_times"),
                   F.min(F.col("last_update") >= F.lit(begun)).alias("since_begin"),
                   F.max(F.col("last_update") <= F.current_timestamp()).alias("before_end"))


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "releases_rollup": releases_rollup,
    "mapped_items": mapped_items,
    "mapped_items_left_join": mapped_items_left_join,
    "mapped_items_keep_null_state": mapped_items_keep_null_state,
    "unmatched_items": unmatched_items,
    "unified_state_counts": unified_state_counts,
    "effective_points": effective_points,
    "release_explode": release_explode,
    "release_explode_outer": release_explode_outer,
    "release_state_long": release_state_long,
    "release_conservation": release_conservation,
    "quality_warn_counts": quality_warn_counts,
    "enforced_releases": enforced_releases,
    "scd1_lineitem_max_by": scd1_lineitem_max_by,
    "scd1_lineitem_row_number": scd1_lineitem_row_number,
    "scd1_events_latest": scd1_events_latest,
    "scd1_ties": scd1_ties,
    "slice_time_inclusive": slice_time_inclusive,
    "slice_and_both": slice_and_both,
    "slice_keyset": slice_keyset,
    "slice_bounded": slice_bounded,
    "next_offset": next_offset,
    "next_offset_minute": next_offset_minute,
    "slice_local_zone": slice_local_zone,
    "slice_local_zone_safe": slice_local_zone_safe,
    "local_zone_clock_change": local_zone_clock_change,
    "project_list_filter": project_list_filter,
    "type_filter_slice": type_filter_slice,
    "id_chunks": id_chunks,
    "id_chunk_bodies": id_chunk_bodies,
    "project_listing": project_listing,
    "envelope_json": envelope_json,
    "ingest_stamp": ingest_stamp,
    "variant_extract_typed": variant_extract_typed,
    "variant_arrays": variant_arrays,
    "variant_dotted_path": variant_dotted_path,
    "variant_lenient": variant_lenient,
    "strip_markup": strip_markup_pages,
    "path_levels": path_levels,
    "closed_parent_tag_flags": closed_parent_tag_flags,
    "releases_latest_name": releases_latest_name,
    "silver_issues_current": silver_issues_current,
    "silver_stories_current": silver_stories_current,
    "stored_variant_paths": stored_variant_paths,
    "gold_views_written": gold_views_written,
    "quality_rule_runs": quality_rule_runs,
    "releases_update_time": releases_update_time,
}
