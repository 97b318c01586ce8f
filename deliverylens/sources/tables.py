"""Driver tables and the two change feeds derived from them.

The reference pulls issues and stories from two trackers' APIs; here the same
bronze envelopes (scalar columns + full JSON body) are derived from the
driver's TPC-H-style tables with Spark, so every query's work grows with the
tables:

* client issues  <- ``orders`` (one issue per order) joined with ``customer``
                    for the reporter.
* internal stories <- ``lineitem``: every row is one revision of the story
                    ``<orderkey>-<linenumber>``; the area path comes from
                    ``supplier``/``nation``/``region``.

The derivation rules below are this project's own fixtures (see FIXTURES.md);
they deliberately create stray blanks, missing estimates, unequal release
arrays, unmapped and NULL states, removed stories and short area paths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import compiled_methods
from .parts import Part, in_part, parts_for

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values (fixtures): client status text by ``o_orderkey % 12``.
CLIENT_STATUS_BY_MOD12 = [
    "Backlog", "In Evaluation", "Approved  to Start", " IN PROGRESS ", "Blocked", "On Hold",
    "Deploy", "Functional Testing", "User Testing", "Done", "Rejected", "Triage",
]
# Fixed values (fixtures): internal board column by line number (1..7; 7 -> NULL);
# ``l_partkey % 11 = 0`` gives the unmapped column ``Ideas``.
BOARD_COLUMN_BY_LINE = {
    1: "New (Backlog-To Do)",
    2: "Active (In-Progress)",
    3: " Dev  Complete ",
    4: "Merged to Client (Resolved)",
    5: "Resolved (User Testing)",
    6: "Closed (Done)",
}
CLIENT_HOST = "https://client.example.net"
INTERNAL_HOST = "https://dev.example.net"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, target: int | None = None) -> DataFrame:
    """Spread a scan that has fewer input splits than the cluster has cores
    (one Parquet row group is one split), so per-row work such as JSON
    building and parsing runs on every core. At cluster scale a scan already
    has thousands of splits and this is a no-op; the check is planning only.

    Rows are hashed on their position in the scan: as even as round-robin
    (exact duplicate rows are spread too, unlike a hash of the row), but
    without round-robin's per-partition sort."""
    target = target or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return dealt(df, target)


def dealt(df: DataFrame, tasks: int) -> DataFrame:
    """``df`` in ``tasks`` even parts, by a hash of the place in the input."""
    return df.repartition(tasks, F.xxhash64(F.monotonically_increasing_id()))


#: Rows of a driver table that one task turns into payloads. A payload is some fifty times as large as what
#: the table's file holds of its row, so tasks by the size of the file would be too large to sort in memory.
ROWS_PER_TASK = 100_000


def payload_tasks(table: DataFrame, part: Part | None = None) -> int:
    """Tasks that build the payloads of a driver table, or of one part of it; the count reads Parquet footers only."""
    rows = table.count() / (part[1] if part else 1)
    return max(table.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] as a literal CASE (index is 0-based)."""
    out = None
    for i, v in enumerate(values):
        out = (F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v)))
    return out


def iso_text(ts: Column, suffix: str = "+0000") -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> ISO-8601 text with an explicit offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit(suffix))


def issue_key() -> Column:
    """Key of the issue of an order."""
    k = F.col("o_orderkey")
    return (F.when(k % 4 == 0, F.concat(F.lit(" ORD-"), k.cast("string"), F.lit(" ")))
            .otherwise(F.concat(F.lit("ORD-"), k.cast("string"))))


def story_key() -> Column:
    """Id of the story of a line item."""
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def client_issue_columns(orders: DataFrame, customer: DataFrame, part: Part | None = None) -> DataFrame:
    """Flat issue attributes, one row per order (the fixture's ``client_items``), or those of one part of the keys.
    The join comes before the rows are dealt out, so that they stay dealt out however it is planned."""
    k = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    quarter = F.quarter("o_orderdate").cast("string")
    empty = F.array().cast("array<string>")
    ids = F.when(k % 10 == 0, empty).otherwise(
        F.array(F.concat(F.lit("V"), year), F.concat(F.lit("V"), year, F.lit("Q"), quarter)))
    names = (F.when(k % 10 == 0, empty)
             .when(k % 17 == 0, F.array(F.concat(F.lit("Release "), year)))
             .otherwise(F.array(F.concat(F.lit("Release "), year),
                                F.concat(F.lit("Release "), year, F.lit(" Q"), quarter))))
    key_text = k.cast("string")
    cust = customer.select("c_custkey", "c_name")
    joined = orders.where(in_part(issue_key(), part)).join(cust, orders.o_custkey == cust.c_custkey, "left").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_name")
    return dealt(joined, payload_tasks(orders, part)).select(
        k.alias("o_orderkey"),
        issue_key().alias("jira_id"),
        F.concat(F.lit("Order "), key_text).alias("jira_name"),
        F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1)).alias("project_key"),
        F.col("o_orderpriority").alias("project_name"),
        F.when(F.col("o_orderstatus") == "F", "Bug").when(F.col("o_orderstatus") == "O", "Story")
         .otherwise("Task").alias("issue_type"),
        _pick(k % 12, CLIENT_STATUS_BY_MOD12).alias("jira_status"),
        F.col("c_name").alias("reporter"),
        F.col("o_orderpriority").alias("priority"),
        F.when(k % 5 == 0, F.lit(None).cast("int")).otherwise((k % 13).cast("int")).alias("jira_story_points"),
        F.when(k % 3 == 0, F.concat(F.lit("EPIC-"), F.col("o_custkey").cast("string"))).alias("parent_jira_id"),
        ids.alias("release_ids"),
        names.alias("release_names"),
        F.array(F.lower("o_orderstatus")).alias("labels"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"),
        F.col("o_orderdate").alias("created"),
        F.when(k % 12 == 9, F.lit("Done")).alias("resolution"),
        F.when(k % 6 == 1, F.lit(None).cast("string")).when(k % 6 == 0, F.lit(RICH_TEXT))
         .otherwise(F.concat(F.lit("Note <b>"), key_text, F.lit("</b>"))).alias("description"),
        F.when(k % 7 != 0, F.concat(F.lit("Person "), (k % 50).cast("string"))).alias("assignee"),
        F.when(k % 9 != 0, F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd"))
         .alias("due_date"),
        (F.col("o_orderdate") + F.when(k % 5 == 2, F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY")))
         .alias("updated"),
    )


def issue_parts(spark: SparkSession, sf_dir: str) -> list[Part]:
    """The parts in which the issue feed is worked on."""
    return parts_for(read_table(spark, sf_dir, "orders").count())


def story_parts(spark: SparkSession, sf_dir: str) -> list[Part]:
    """The parts in which the story feed is worked on."""
    return parts_for(read_table(spark, sf_dir, "lineitem").count())


# Stands for a description that is an object, which one JSON schema cannot say beside text.
RICH_TEXT = "@rich-text@"


def client_issues_bronze(spark: SparkSession, sf_dir: str, as_of: str | None = None,
                         changes: bool = False, part: Part | None = None) -> DataFrame:
    """Bronze issues: ``jira_internal_id, project, key, summary, issue_type,
    updated, url, raw_data`` (STRING) + ``extraction_timestamp``. With ``changes``
    every fifth issue also has the earlier change that created it, as ``Backlog``.
    ``part``: only the issues whose ``key`` is in it."""
    compiled_methods(spark)
    flat = client_issue_columns(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"), part)
    if changes:
        # Both changes from one row: a union would read, join and deal out the orders once for each.
        change = F.struct(F.col("updated"), F.col("jira_status"))
        creation = F.struct(F.col("created").alias("updated"), F.lit("Backlog").alias("jira_status"))
        each = F.when(F.col("updated") > F.col("created"), F.array(change, creation)).otherwise(F.array(change))
        flat = flat.withColumn("_change", F.explode(each)).withColumns(
            {c: F.col(f"_change.{c}") for c in ("updated", "jira_status")}).drop("_change")
    versions = F.transform(
        F.arrays_zip(F.col("release_ids").alias("id"), F.col("release_names").alias("name")),
        lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name")))
    created, updated = iso_text(F.col("created")), iso_text(F.col("updated"))
    rich = F.concat(F.lit('{"type":"doc","text":"Order '), F.col("o_orderkey").cast("string"), F.lit('"}'))
    fields = F.struct(
        F.struct(F.col("project_key").alias("key"), F.col("project_name").alias("name")).alias("project"),
        F.col("jira_name").alias("summary"),
        F.struct(F.col("issue_type").alias("name")).alias("issuetype"),
        F.struct(F.col("jira_status").alias("name")).alias("status"),
        F.col("description").alias("description"),
        F.struct(F.col("reporter").alias("displayName")).alias("reporter"),
        F.when(F.col("assignee").isNotNull(), F.struct(F.col("assignee").alias("displayName"))).alias("assignee"),
        F.struct(F.col("priority").alias("name")).alias("priority"),
        F.col("jira_story_points").alias("customfield_10022"),
        F.when(F.col("parent_jira_id").isNotNull(),
               F.struct(F.col("parent_jira_id").alias("key"))).alias("parent"),
        versions.alias("fixVersions"),
        F.col("labels").alias("labels"),
        F.col("start_date").alias("customfield_10015"),
        F.col("due_date").alias("duedate"),
        created.alias("created"),
        updated.alias("updated"),
        F.when(F.col("resolution").isNotNull(), F.struct(F.col("resolution").alias("name"))).alias("resolution"),
    )
    body = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("jira_id").alias("key"),
                    fields.alias("fields"))
    stamp = F.to_timestamp(F.lit(as_of)) if as_of else F.current_timestamp()
    return flat.select(
        F.col("o_orderkey").cast("string").alias("jira_internal_id"),
        F.col("project_key").alias("project"),
        F.col("jira_id").alias("key"),
        F.col("jira_name").alias("summary"),
        F.col("issue_type"),
        updated.alias("updated"),
        F.concat(F.lit(f"{CLIENT_HOST}/browse/"), F.col("jira_id")).alias("url"),
        F.replace(F.to_json(body), F.lit(f'"{RICH_TEXT}"'), rich).alias("raw_data"),
        stamp.alias("extraction_timestamp"),
    )


def area_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``s_suppkey -> region\\nation\\supplier`` cut to two levels when the key
    is a multiple of 3, else to one level when it is a multiple of 7."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)  # 25 x 5 rows: tiny, planned as a broadcast
    joined = s.join(geo, s.s_nationkey == geo.n_nationkey, "left")
    sep = F.lit("\\")
    path = (F.when(F.col("s_suppkey") % 3 == 0, F.concat_ws("\\", "r_name", "n_name"))
            .when(F.col("s_suppkey") % 7 == 0, F.col("r_name"))
            .otherwise(F.concat(F.col("r_name"), sep, F.col("n_name"), sep, F.col("s_name"))))
    return joined.select("s_suppkey", path.alias("area_path"))


def internal_story_columns(lines: DataFrame, paths: DataFrame, part: Part | None = None) -> DataFrame:
    """Flat story attributes, one row per lineitem row (the fixture's ``internal_items``
    once reduced to the latest row per key); dealt out after the join, in parts by the id, as the issues are."""
    ln = F.col("l_linenumber")
    sid = story_key()
    client = (F.when(ln == 7, F.lit(None).cast("string"))
              .when(ln == 3, F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string"), F.lit(" ")))
              .otherwise(F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string"))))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    state = (F.when((rf == "R") & (ls == "F"), "Removed").when(ls == "F", "Closed")
             .when(rf == "N", "New").when(rf == "A", "Active"))
    board = F.when(F.col("l_partkey") % 11 == 0, F.lit("Ideas"))
    for line, text in BOARD_COLUMN_BY_LINE.items():
        board = board.when(ln == line, F.lit(text))
    joined = lines.where(in_part(sid, part)).join(paths, lines.l_suppkey == paths.s_suppkey, "left").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        "l_shipdate", "area_path")
    return dealt(joined, payload_tasks(lines, part)).select(
        sid.alias("id"),
        F.col("l_partkey").cast("int").alias("rev"),
        F.concat(F.lit("Line "), sid).alias("title"),
        client.alias("client_id"),
        state.alias("state"),
        board.alias("board_column"),
        F.when(F.col("l_quantity") > 40, F.lit(None).cast("int"))
         .otherwise(F.col("l_quantity").cast("int")).alias("story_points"),
        F.col("area_path"),
        F.concat(F.lit("Delivery\\"), F.year("l_shipdate").cast("string"), F.lit("\\S"),
                 F.month("l_shipdate").cast("string")).alias("iteration_path"),
        F.when(ln == 2, F.lit(None).cast("string")).when(ln == 6, F.lit("  "))
         .otherwise(F.concat(F.col("l_returnflag"), F.lit("; "), F.col("l_linestatus"))).alias("tags"),
        (ln % 4 + 1).cast("int").alias("priority"),
        F.col("l_orderkey").alias("parent_id"),
        F.col("l_shipdate").alias("changed"),
        F.when(ln % 2 == 0, F.lit("Moved")).alias("reason"),
        F.expr("l_shipdate - INTERVAL 10 DAYS").alias("created"),
        F.concat(F.lit("Author "), (F.col("l_suppkey") % 10).cast("string")).alias("created_by"),
        F.concat(F.lit("Editor "), (F.col("l_partkey") % 10).cast("string")).alias("changed_by"),
        F.when(ln != 5, F.concat(F.lit("Dev "), (F.col("l_suppkey") % 7).cast("string"))).alias("assigned_to"),
        F.concat(F.lit("<p>Line <b>"), sid, F.lit("</b></p>")).alias("description_html"),
        F.when(ln != 4, F.concat(F.lit("<ul><li>"), F.col("l_quantity").cast("int").cast("string"),
                                 F.lit("</li></ul>"))).alias("acceptance_html"),
        (ln == 6).alias("board_done"),
        F.expr("l_shipdate - INTERVAL 1 DAY").alias("state_changed"),
        F.when(rf != "N", F.expr("l_shipdate - INTERVAL 5 DAYS")).alias("activated"),
        F.when(ls == "F", F.col("l_shipdate")).alias("closed"),
        F.concat(F.lit("TT-"), (F.col("l_suppkey") % 5).cast("string")).alias("tracking_project"),
        F.when(ln % 3 != 0, (F.col("l_partkey") % 100).cast("string")).alias("tracking_product"),
    )


def latest_lines(lineitem: DataFrame, method: str = "row_number") -> DataFrame:
    """Latest ``lineitem`` row per (orderkey, linenumber) by (shipdate, partkey,
    suppkey, extendedprice), a total order within every key."""
    from ..operators.scd import latest_per_key
    return latest_per_key(lineitem, ["l_orderkey", "l_linenumber"],
                          ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"], method=method)


def internal_stories_bronze(spark: SparkSession, sf_dir: str, as_of: str | None = None,
                            part: Part | None = None) -> DataFrame:
    """Bronze stories: ``org, project, id, rev, title, url, raw_data`` (STRING) +
    ``extraction_timestamp``. ``part``: only the stories whose ``id`` is in it."""
    compiled_methods(spark)
    flat = internal_story_columns(read_table(spark, sf_dir, "lineitem"), area_paths(spark, sf_dir), part)
    url = F.concat(F.lit(f"{INTERNAL_HOST}/_workitems/edit/"), F.col("id"))
    fields = F.struct(
        F.lit("User Story").alias("System.WorkItemType"),
        F.col("state").alias("System.State"),
        F.col("area_path").alias("System.AreaPath"),
        F.col("iteration_path").alias("System.IterationPath"),
        F.col("title").alias("System.Title"),
        iso_text(F.col("changed"), "Z").alias("System.ChangedDate"),
        F.col("parent_id").alias("System.Parent"),
        F.col("tags").alias("System.Tags"),
        F.col("board_column").alias("System.BoardColumn"),
        F.col("priority").alias("Microsoft.VSTS.Common.Priority"),
        F.col("story_points").alias("Microsoft.VSTS.Scheduling.StoryPoints"),
        F.col("client_id").alias("Custom.Client_ID"),
        F.col("reason").alias("System.Reason"),
        iso_text(F.col("created"), "Z").alias("System.CreatedDate"),
        F.struct(F.col("created_by").alias("displayName")).alias("System.CreatedBy"),
        F.struct(F.col("changed_by").alias("displayName")).alias("System.ChangedBy"),
        F.when(F.col("assigned_to").isNotNull(),
               F.struct(F.col("assigned_to").alias("displayName"))).alias("System.AssignedTo"),
        F.col("description_html").alias("System.Description"),
        F.col("acceptance_html").alias("Microsoft.VSTS.Common.AcceptanceCriteria"),
        F.col("board_done").alias("System.BoardColumnDone"),
        iso_text(F.col("state_changed"), "Z").alias("Microsoft.VSTS.Common.StateChangeDate"),
        iso_text(F.col("activated"), "Z").alias("Microsoft.VSTS.Common.ActivatedDate"),
        iso_text(F.col("closed"), "Z").alias("Microsoft.VSTS.Common.ClosedDate"),
        F.col("tracking_project").alias("Custom.TimeTrackingProject"),
        F.col("tracking_product").alias("Custom.TimeTrackingProductID"),
    )
    body = F.struct(F.col("id"), F.col("rev"), url.alias("url"), fields.alias("fields"))
    stamp = F.to_timestamp(F.lit(as_of)) if as_of else F.current_timestamp()
    return flat.select(
        F.lit("internal").alias("org"),
        F.lit("Delivery").alias("project"),
        F.col("id"),
        F.col("rev").cast("string").alias("rev"),
        F.col("title"),
        url.alias("url"),
        F.to_json(body).alias("raw_data"),
        stamp.alias("extraction_timestamp"),
    )
