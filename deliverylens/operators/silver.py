"""Bronze -> silver: parse the raw payload once, read typed fields, derive flags.

Narrow transformations only (no shuffle): every column is a projection of the
same row, so a bronze scan streams straight through.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import (FieldSpec, array_field_ids, field_col, field_of, fields_read, parse_payload, path_level,
                                 path_parts, strip_markup, walkable)
from ..functions.states import CLIENT_CLOSED_STATUSES, INTERNAL_CLOSED_STATES

# ---------------------------------------------------------------------------
# Payload paths of the two trackers (they must match the
# trackers' field names, so they equal the reference's extraction paths).
ISSUE_FIELDS = [
    FieldSpec("project_name_payload", "$.fields.project.name"),
    FieldSpec("status", "$.fields.status.name"),
    FieldSpec("description", "$.fields.description"),
    FieldSpec("reporter", "$.fields.reporter.displayName"),
    FieldSpec("assignee", "$.fields.assignee.displayName"),
    FieldSpec("priority", "$.fields.priority.name"),
    FieldSpec("story_points", "$.fields.customfield_10022", "int"),
    FieldSpec("parent_jira_id", "$.fields.parent.key"),
    FieldSpec("fix_versions", "$.fields.fixVersions", "array<variant>"),
    FieldSpec("labels", "$.fields.labels", "array<string>"),
    FieldSpec("start_date", "$.fields.customfield_10015"),
    FieldSpec("due_date", "$.fields.duedate"),
    FieldSpec("created_date", "$.fields.created", "timestamp"),
    FieldSpec("updated_date", "$.fields.updated", "timestamp"),
    FieldSpec("resolution", "$.fields.resolution.name"),
]
STORY_FIELDS = [
    FieldSpec("work_item_type", '$.fields["System.WorkItemType"]'),
    FieldSpec("state", '$.fields["System.State"]'),
    FieldSpec("reason", '$.fields["System.Reason"]'),
    FieldSpec("area_path", '$.fields["System.AreaPath"]'),
    FieldSpec("iteration_path", '$.fields["System.IterationPath"]'),
    FieldSpec("created_date", '$.fields["System.CreatedDate"]', "timestamp"),
    FieldSpec("changed_date", '$.fields["System.ChangedDate"]', "timestamp"),
    FieldSpec("created_by", '$.fields["System.CreatedBy"].displayName'),
    FieldSpec("changed_by", '$.fields["System.ChangedBy"].displayName'),
    FieldSpec("assigned_to", '$.fields["System.AssignedTo"].displayName'),
    FieldSpec("parent_id", '$.fields["System.Parent"]', whole=True),
    FieldSpec("tags", '$.fields["System.Tags"]'),
    FieldSpec("description_html", '$.fields["System.Description"]'),
    FieldSpec("acceptance_criteria_html", '$.fields["Microsoft.VSTS.Common.AcceptanceCriteria"]'),
    FieldSpec("board_column", '$.fields["System.BoardColumn"]'),
    FieldSpec("board_column_done", '$.fields["System.BoardColumnDone"]', "boolean"),
    FieldSpec("priority", '$.fields["Microsoft.VSTS.Common.Priority"]', "int"),
    FieldSpec("story_points", '$.fields["Microsoft.VSTS.Scheduling.StoryPoints"]', "int"),
    FieldSpec("state_change_date", '$.fields["Microsoft.VSTS.Common.StateChangeDate"]', "timestamp"),
    FieldSpec("activated_date", '$.fields["Microsoft.VSTS.Common.ActivatedDate"]', "timestamp"),
    FieldSpec("closed_date", '$.fields["Microsoft.VSTS.Common.ClosedDate"]', "timestamp"),
    FieldSpec("time_tracking_project", '$.fields["Custom.TimeTrackingProject"]'),
    FieldSpec("time_tracking_product_id", '$.fields["Custom.TimeTrackingProductID"]'),
    FieldSpec("client_id", '$.fields["Custom.Client_ID"]'),
]
# ---------------------------------------------------------------------------


# The payload field that a derived column comes from.
ISSUE_DERIVED = {"project_name": "project_name_payload", "fix_version_ids": "fix_versions", "is_closed": "status",
                 "has_parent": "parent_jira_id"}
STORY_DERIVED = {"description": "description_html", "acceptance_criteria": "acceptance_criteria_html",
                 "client": "area_path", "sprint_name": "iteration_path", "is_closed": "state",
                 "has_parent": "parent_id", "has_tags": "tags",
                 **{f"area_level_{i}": "area_path" for i in (1, 2, 3)},
                 **{f"iteration_level_{i}": "iteration_path" for i in (1, 2, 3)}}

_READ = "_read"


def _fields(parsed: DataFrame, v: str, specs: list[FieldSpec], derived: dict[str, str],
            wanted: list[str] | None) -> tuple[DataFrame, list]:
    """``parsed`` with its payload walked once, and a column for each of ``specs``. The walk reads those that the
    ``wanted`` output columns need (all, if None); the others are read by path, if at all."""
    need = None if wanted is None else {derived.get(c, c) for c in wanted}
    walked = walkable([s for s in specs if need is None or s.name in need])
    if not walked:
        return parsed, [field_col(v, s) for s in specs]
    return (parsed.withColumn(_READ, fields_read(v, walked)),
            [field_of(_READ, v, s) if s in walked else field_col(v, s) for s in specs])


def _with_mode(specs: list[FieldSpec], mode: str) -> list[FieldSpec]:
    return [replace(s, mode=mode) for s in specs]


PAYLOAD_HASH = "payload_hash"


def _payload_hash(with_hash: bool) -> list:
    """Optional 64-bit hash of the raw payload text: the last-resort sequence
    field that makes equal sequences resolve deterministically."""
    return [F.xxhash64("raw_data").alias(PAYLOAD_HASH)] if with_hash else []


def parse_issues(bronze: DataFrame, mode: str = "strict", with_hash: bool = False,
                 wanted: list[str] | None = None) -> DataFrame:
    """Bronze issues (envelope + ``raw_data`` JSON text) -> parsed issues, 25 columns
    (+ ``payload_hash`` when ``with_hash``). ``wanted``: output columns that will be used, if not all.

    ``fix_version_ids`` is derived from the already extracted ``fix_versions``
    array, so the path is read once.
    """
    specs = _with_mode(ISSUE_FIELDS, mode)
    v = parse_payload("raw_data", lenient=(mode == "try"))
    extra = [PAYLOAD_HASH] if with_hash else []
    base, fields = _fields(bronze.select(
        "jira_internal_id", "key", "summary", "project", "issue_type", "url", "extraction_timestamp",
        v.alias("_v"), *_payload_hash(with_hash),
    ), "_v", specs, ISSUE_DERIVED, wanted)
    parsed = base.select(
        "jira_internal_id", "key", "summary", "project", "issue_type", "url", "extraction_timestamp", *fields, *extra,
    )
    return parsed.select(
        F.col("jira_internal_id"),
        F.col("key").alias("jira_id"),
        F.col("summary").alias("jira_name"),
        F.col("project").alias("project_key"),
        F.coalesce(F.col("project_name_payload"), F.col("project")).alias("project_name"),
        F.col("issue_type"),
        F.col("status"),
        F.col("description"),
        F.col("reporter"),
        F.col("assignee"),
        F.col("priority"),
        F.col("story_points"),
        F.col("parent_jira_id"),
        F.col("fix_versions"),
        array_field_ids(F.col("fix_versions")).alias("fix_version_ids"),
        F.col("labels"),
        F.col("start_date"),
        F.col("due_date"),
        F.col("created_date"),
        F.col("updated_date"),
        F.col("resolution"),
        F.col("url"),
        F.col("extraction_timestamp"),
        F.trim(F.col("status")).isin(*CLIENT_CLOSED_STATUSES).eqNullSafe(True).alias("is_closed"),
        F.col("parent_jira_id").isNotNull().alias("has_parent"),
        *[F.col(c) for c in extra],
    )


def parse_stories(bronze: DataFrame, mode: str = "strict", keep_payload: bool = True,
                  with_hash: bool = False, wanted: list[str] | None = None) -> DataFrame:
    """Bronze stories -> parsed stories, 45 columns (the parsed payload is kept
    as VARIANT when ``keep_payload``; + ``payload_hash`` when ``with_hash``).
    ``wanted``: as for :func:`story_fields`."""
    out = derive_story_columns(story_fields(bronze, mode, with_hash, wanted))
    return out if keep_payload else out.drop("raw_data")


def story_fields(bronze: DataFrame, mode: str = "strict", with_hash: bool = False,
                 wanted: list[str] | None = None) -> DataFrame:
    """Bronze stories -> the fields of the payload and the payload as VARIANT, without what is derived from them.
    ``wanted``: columns, derived ones included, that will be used, if not all."""
    specs = _with_mode(STORY_FIELDS, mode)
    v = parse_payload("raw_data", lenient=(mode == "try"))
    extra = [PAYLOAD_HASH] if with_hash else []
    base, fields = _fields(bronze.select(
        F.col("id").cast("string").alias("id"),
        (F.col("rev").cast("int") if mode == "strict" else F.col("rev").try_cast("int")).alias("rev"),
        "title", "url", "org", "project", "extraction_timestamp",
        v.alias("raw_data"), *_payload_hash(with_hash),
    ), "raw_data", specs, STORY_DERIVED, wanted)
    return base.select(
        "id", "rev", "title", "url", "org", "project", *fields,
        "extraction_timestamp", "raw_data", *extra,
    )


def derive_story_columns(fields: DataFrame) -> DataFrame:
    """The columns that follow from the fields of a story: it may be reduced to the latest rows before."""
    parsed = fields.withColumns({"_area": path_parts("area_path"), "_iter": path_parts("iteration_path")})
    return parsed.withColumns({
        "description": strip_markup("description_html"),
        "acceptance_criteria": strip_markup("acceptance_criteria_html"),
        "client": path_level(F.col("_area"), -1),
        "sprint_name": path_level(F.col("_iter"), -1),
        "area_level_1": path_level(F.col("_area"), 1),
        "area_level_2": path_level(F.col("_area"), 2),
        "area_level_3": path_level(F.col("_area"), 3),
        "iteration_level_1": path_level(F.col("_iter"), 1),
        "iteration_level_2": path_level(F.col("_iter"), 2),
        "iteration_level_3": path_level(F.col("_iter"), 3),
        "is_closed": F.trim(F.col("state")).isin(*INTERNAL_CLOSED_STATES).eqNullSafe(True),
        "has_parent": F.col("parent_id").isNotNull(),
        "has_tags": (F.col("tags").isNotNull() & (F.trim(F.col("tags")) != "")).eqNullSafe(True),
    }).drop("_area", "_iter")
