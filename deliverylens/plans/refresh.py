"""Batch refresh: bronze -> silver -> current -> gold.

``latest_issues``, ``latest_stories`` and ``write_gold`` take tables; the
functions with ``sf_dir`` call them on the feeds derived from the driver's
tables. Those write the two current tables below ``spark.checkpoint.dir``
before they return (see :func:`materialise`); nothing is collected. Large
feeds and tables are reduced and joined in parts (``sources.parts``), each
written before the next is begun.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.gold import ROLLUP_INPUT, STORY_SIDE, map_items, release_rollup, silver_columns_for
from ..operators.scd import latest_per_key
from ..operators.silver import PAYLOAD_HASH, derive_story_columns, parse_issues, story_fields
from ..session import scratch_path
from ..sources import versions
from ..sources.parts import Part, in_part, part_number, parts_for, shuffles_dropped
from ..sources.tables import client_issues_bronze, internal_stories_bronze, issue_parts, story_parts

# Keys and sequences of the two change flows. The issue flow is the
# reference's; the story feed derived from line items carries its change time
# in ``changed_date`` and a per-key tie breaker in ``rev``, so the ingest stamp
# comes last there.
ISSUE_KEYS = ["jira_id"]
ISSUE_SEQUENCE = ["updated_date", "extraction_timestamp"]
STORY_KEYS = ["id"]
STORY_SEQUENCE = ["rev", "extraction_timestamp"]
FEED_STORY_SEQUENCE = ["changed_date", "rev", "extraction_timestamp"]

# Column of a written table that says in which part of the mapping a row is joined; its metadata has their number.
PART = "_part"
_PARTS = "parts"

# Folder of the quality record beside the gold views.
RULE_RUNS = "rule_runs"

GOLD_ISSUE_COLUMNS = [
    "jira_id", "jira_name", "project_name", "issue_type", "status", "description", "reporter",
    "assignee", "priority", "story_points", "parent_jira_id", "fix_versions", "fix_version_ids",
    "labels", "start_date", "due_date", "created_date", "updated_date", "resolution", "url",
    "is_closed", "extraction_timestamp",
]
GOLD_STORY_COLUMNS = sorted({src for _, src in STORY_SIDE} | {"client_id", "changed_date", "extraction_timestamp"})


def latest_issues(bronze: DataFrame, method: str = "row_number", columns: list[str] | None = None,
                  tie_break: bool = True) -> DataFrame:
    """Latest parsed issue per key of a bronze table. ``tie_break`` adds the payload
    hash as the last sequence field (equal sequences resolve deterministically)."""
    parsed = parse_issues(bronze, with_hash=tie_break, wanted=columns and columns + ISSUE_SEQUENCE)
    return _latest(parsed, ISSUE_KEYS, ISSUE_SEQUENCE, method, columns, tie_break)


def latest_stories(bronze: DataFrame, method: str = "row_number", columns: list[str] | None = None,
                   tie_break: bool = True, sequence: list[str] | None = None) -> DataFrame:
    """Latest parsed story per key of a bronze table, by the tracker's own sequence unless another is given.
    What follows from the payload's fields is derived from the latest rows, so that only the fields are shuffled."""
    sequence = sequence or STORY_SEQUENCE
    fields = story_fields(bronze, with_hash=tie_break, wanted=columns and columns + sequence)
    if columns:
        fields = fields.drop("raw_data")
    latest = derive_story_columns(_latest(fields, STORY_KEYS, sequence, method, None, tie_break))
    return latest.select(*columns) if columns else latest


def current_issues(spark: SparkSession, sf_dir: str, as_of: str | None = None, part: Part | None = None,
                   **kwargs) -> DataFrame:
    return latest_issues(client_issues_bronze(spark, sf_dir, as_of=as_of, changes=True, part=part), **kwargs)


def current_stories(spark: SparkSession, sf_dir: str, as_of: str | None = None, part: Part | None = None,
                    **kwargs) -> DataFrame:
    """All line-item revisions parsed, then reduced to the latest per story; those of one part if it is named."""
    return latest_stories(internal_stories_bronze(spark, sf_dir, as_of=as_of, part=part),
                          sequence=FEED_STORY_SEQUENCE, **kwargs)


def stories_by_parts(spark: SparkSession, sf_dir: str, as_of: str | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """:func:`current_stories` without the columns ``drop``; written part by part where the feed has more than one."""
    parts = story_parts(spark, sf_dir)
    each = [current_stories(spark, sf_dir, as_of, part=p).drop(*drop) for p in parts]
    return each[0] if len(each) == 1 else written(spark, each, "stories")[0]


def _latest(parsed: DataFrame, keys: list[str], sequence: list[str], method: str,
            columns: list[str] | None, tie_break: bool) -> DataFrame:
    if columns:
        parsed = parsed.select(*columns, *([PAYLOAD_HASH] if tie_break else []))
    out = latest_per_key(parsed, keys, sequence, method=method,
                         tie_break=F.col(PAYLOAD_HASH) if tie_break else None)
    return out.drop(PAYLOAD_HASH) if tie_break else out


def current_tables(spark: SparkSession, sf_dir: str, as_of: str | None = None,
                   columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver current tables for gold, written once below the shared folder
    (as the reference stores them) and read back. Gold reads each of them
    twice (inner and anti branch of the skew-safe mapping); from a written
    table that is two pruned scans instead of two re-derivations.

    ``columns`` (mapping output names) narrows both tables to the silver
    columns those outputs need, so only those payload paths are extracted."""
    (issues, _), (stories, _) = _written_tables(spark, sf_dir, as_of, columns)
    return issues, stories


def _written_tables(spark: SparkSession, sf_dir: str, as_of: str | None,
                    columns: list[str] | None) -> tuple[tuple[DataFrame, str], tuple[DataFrame, str]]:
    """:func:`current_tables` and their folders."""
    issue_cols, story_cols = silver_columns_for(columns)
    issue_cols = sorted(set(issue_cols) | set(ISSUE_KEYS) | set(ISSUE_SEQUENCE))
    story_cols = sorted(set(story_cols) | set(STORY_KEYS) | set(FEED_STORY_SEQUENCE))
    of_issues, of_stories = issue_parts(spark, sf_dir), story_parts(spark, sf_dir)
    joined = len(of_issues) + len(of_stories) - 1
    issues = (current_issues(spark, sf_dir, as_of, part=p, columns=issue_cols) for p in of_issues)
    stories = (current_stories(spark, sf_dir, as_of, part=p, columns=story_cols) for p in of_stories)
    return (written(spark, issues, "issues-current", "jira_id", joined),
            written(spark, stories, "stories-current", "client_id", joined))


def mapped(spark: SparkSession, sf_dir: str, as_of: str | None = None, strategy: str = "skew_safe",
           keep_null_state: bool = False, columns: list[str] | None = None) -> DataFrame:
    (issues, *at), (stories, *there) = _written_tables(spark, sf_dir, as_of, columns)
    return map_by_parts(issues, stories, at + there, strategy=strategy, keep_null_state=keep_null_state, columns=columns)


def map_by_parts(issues: DataFrame, stories: DataFrame, spent: Iterable[str] = (), **options) -> DataFrame:
    """:func:`map_items` of two current tables; where they are joined in more than one part, as a written table.
    ``spent``: folders of the two that nothing else reads, whose parts go once they are joined."""
    pairs = _pairs(issues, stories)
    if len(pairs) == 1:
        return map_items(*pairs[0], **options)
    spark = issues.sparkSession

    def joined(k: int) -> None:
        for path in spent:
            versions.remove(spark, f"{path}/{PART}={k}")

    return written(spark, (map_items(*pair, **options) for pair in pairs), "mapped", done=joined)[0]


def _pairs(issues: DataFrame, stories: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """The two tables in the parts of their match keys. Tables written for that are split already; of others,
    each part is another scan."""
    split = {t.schema[PART].metadata.get(_PARTS) if PART in t.columns else None for t in (issues, stories)}
    if len(split) == 1 and None not in split:
        return [(issues.where(F.col(PART) == k), stories.where(F.col(PART) == k)) for k in range(split.pop())]
    parts = parts_for(issues.count() + stories.count())
    if len(parts) == 1:
        return [(issues, stories)]
    return [(issues.where(in_part(F.trim("jira_id"), p)), stories.where(in_part(F.trim("client_id"), p))) for p in parts]


def releases(spark: SparkSession, sf_dir: str, as_of: str | None = None, **kwargs) -> DataFrame:
    """The flagship: per-release roll-up straight from the change feeds."""
    return release_rollup(mapped(spark, sf_dir, as_of, columns=ROLLUP_INPUT), as_of=as_of, **kwargs)


def write_gold(issues: DataFrame, stories: DataFrame, out_dir: str, as_of: str | None = None):
    """Materialise the gold views of two current tables (read by name or path,
    ``spark.table(...)``): the 42-column mapping (warn rule observed while it is
    written) and the 17-column releases table (fail rule and NOT NULL checked
    inline). Each is written as a new version below ``out_dir``, so a row that
    breaks a rule stops its write and leaves the last good version in place;
    read them with :func:`read_gold`. What the rules counted is appended to the
    table of :func:`rule_runs`. Returns the warn observation."""
    from ..operators import gold, quality

    run = uuid.uuid4().hex
    mapped_parts = [quality.enforce_schema(map_items(*pair), gold.MAPPED_ITEMS_DDL) for pair in _pairs(issues, stories)]
    warn = _publish_counted(mapped_parts, out_dir, "mapped_items", [gold.MAPPING_WARN_RULE], "warn", run)
    rel = release_rollup(read_gold(issues.sparkSession, out_dir, "mapped_items"), as_of=as_of, order=False)
    _publish_counted(rel, out_dir, "releases", [gold.RELEASE_FAIL_RULE], "fail", run,
                     lambda df: quality.enforce_schema(quality.with_fail_rules(df, [gold.RELEASE_FAIL_RULE]),
                                                       gold.RELEASES_DDL))
    return warn


def _publish_counted(df: DataFrame | list[DataFrame], out_dir: str, view: str, rules: list, action: str, run: str,
                     guard=lambda df: df):
    """Publish ``guard(df)``, or that of its parts, counting in the same pass, and record the run however it ends."""
    from ..operators import quality

    parts = df if isinstance(df, list) else [df]
    spark = parts[0].sparkSession
    counted = [quality.with_counts(df, rules, view) for df in parts]
    seen = quality.Counts([observation for _, observation in counted])
    try:
        with shuffles_dropped(spark):
            version = versions.publish([guard(part) for part, _ in counted], f"{out_dir}/{view}")
    except Exception:
        quality.record_run(spark, f"{out_dir}/{RULE_RUNS}", run, view, rules, action, None, None)
        raise
    quality.record_run(spark, f"{out_dir}/{RULE_RUNS}", run, view, rules, action, version, seen.get)
    return seen


def rule_runs(spark: SparkSession, out_dir: str) -> DataFrame:
    """A row per quality rule and run of :func:`write_gold`, from the first on."""
    from ..operators import quality

    return spark.read.schema(quality.RULE_RUNS_DDL).parquet(f"{out_dir}/{RULE_RUNS}")


def read_gold(spark: SparkSession, out_dir: str, view: str) -> DataFrame | None:
    """The last good version of a gold view, None before the first."""
    return versions.current(spark, f"{out_dir}/{view}")


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: cuts
    lineage and survives executor loss (unlike a local checkpoint)."""
    return written(spark, [df], name)[0]


def written(spark: SparkSession, parts: Iterable[DataFrame], name: str, split_by: str | None = None,
            splits: int = 1, done: Callable[[int], None] = lambda k: None) -> tuple[DataFrame, str]:
    """:func:`materialise` for a table that comes in ``parts``, one after the other; also its folder. With more than
    one of ``splits`` its rows are put into folders by the part of the mapping that their key ``split_by`` is in.
    ``done`` is called with the number of each part once it is written."""
    path = scratch_path(spark, name)
    for k, df in enumerate(parts):
        schema = df.schema
        if splits > 1:
            df = df.withColumn(PART, part_number(F.trim(split_by), splits))
        writer = df.write.mode("append").option("compression", "zstd")
        with shuffles_dropped(spark):
            (writer.partitionBy(PART) if splits > 1 else writer).parquet(path)
        done(k)
    if splits == 1:
        return spark.read.schema(schema).parquet(path), path
    rows = spark.read.schema(StructType([*schema.fields, StructField(PART, IntegerType())])).parquet(path)
    return rows.withColumn(PART, F.col(PART).alias(PART, metadata={_PARTS: splits})), path
