r"""Independent DuckDB SQL for every catalogue query.

The derivations restate FIXTURES.md from the base tables directly (no JSON
round trip), so an error in the Spark payload path or in the Spark operators
shows up as a mismatch. Array columns are rendered as ``a|b|NULL`` text, as
in the catalogue.
"""

from __future__ import annotations

from ..functions.states import CLIENT_STATUS_MAP, INTERNAL_STATUS_MAP, UNIFIED_STATES
from ..sources.tables import BOARD_COLUMN_BY_LINE, CLIENT_HOST, CLIENT_STATUS_BY_MOD12, INTERNAL_HOST  # noqa: F401
from . import catalogue as c


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_mod(expr: str, values: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {i} THEN {_q(v)}" for i, v in enumerate(values)) + " END"


def _arr(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: coalesce(CAST(x AS VARCHAR), {_q(c.NULL_MARK)})), '|')"


def _ts(text: str) -> str:
    return f"TIMESTAMP {_q(text.replace('T', ' ').rstrip('Z'))}"


_BOARD = "CASE WHEN l_partkey % 11 = 0 THEN 'Ideas' " + " ".join(
    f"WHEN l_linenumber = {k} THEN {_q(v)}" for k, v in BOARD_COLUMN_BY_LINE.items()) + " END"

CLIENT = rf"""
issues AS (
  SELECT o.o_orderkey AS k,
    CASE WHEN o.o_orderkey % 4 = 0 THEN ' ORD-' || o.o_orderkey || ' ' ELSE 'ORD-' || o.o_orderkey END AS jira_id,
    'Order ' || o.o_orderkey AS jira_name,
    'P' || substr(o.o_orderpriority, 1, 1) AS project_key,
    o.o_orderpriority AS project_name,
    CASE o.o_orderstatus WHEN 'F' THEN 'Bug' WHEN 'O' THEN 'Story' ELSE 'Task' END AS issue_type,
    {_case_mod('o.o_orderkey % 12', CLIENT_STATUS_BY_MOD12)} AS status,
    c.c_name AS reporter,
    o.o_orderpriority AS priority,
    CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(o.o_orderkey % 13 AS INTEGER) END AS story_points,
    CASE WHEN o.o_orderkey % 3 = 0 THEN 'EPIC-' || o.o_custkey END AS parent_jira_id,
    CASE WHEN o.o_orderkey % 10 = 0 THEN CAST([] AS VARCHAR[])
         ELSE ['V' || year(o.o_orderdate), 'V' || year(o.o_orderdate) || 'Q' || quarter(o.o_orderdate)] END AS release_ids,
    CASE WHEN o.o_orderkey % 10 = 0 THEN CAST([] AS VARCHAR[])
         WHEN o.o_orderkey % 17 = 0 THEN ['Release ' || year(o.o_orderdate), NULL]
         ELSE ['Release ' || year(o.o_orderdate), 'Release ' || year(o.o_orderdate) || ' Q' || quarter(o.o_orderdate)] END
      AS release_names,
    [lower(o.o_orderstatus)] AS labels,
    strftime(o.o_orderdate, '%Y-%m-%d') AS start_date,
    o.o_orderdate AS created,
    CASE WHEN o.o_orderkey % 12 = 9 THEN 'Done' END AS resolution,
    CASE o.o_orderkey % 6 WHEN 1 THEN NULL WHEN 0 THEN '{{"text":"Order ' || o.o_orderkey || '","type":"doc"}}'
         ELSE 'Note <b>' || o.o_orderkey || '</b>' END AS description,
    CASE WHEN o.o_orderkey % 7 <> 0 THEN 'Person ' || o.o_orderkey % 50 END AS assignee,
    CASE WHEN o.o_orderkey % 9 <> 0 THEN strftime(o.o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS due_date,
    CASE WHEN o.o_orderkey % 5 = 2 THEN o.o_orderdate + INTERVAL 1 DAY ELSE o.o_orderdate END AS updated
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
)"""

PATHS = r"""
paths AS (
  SELECT s.s_suppkey,
    CASE WHEN s.s_suppkey % 3 = 0 THEN r.r_name || '\' || n.n_name
         WHEN s.s_suppkey % 7 = 0 THEN r.r_name
         ELSE r.r_name || '\' || n.n_name || '\' || s.s_name END AS area_path
  FROM supplier s LEFT JOIN (nation n JOIN region r ON n.n_regionkey = r.r_regionkey) ON s.s_nationkey = n.n_nationkey
)"""

LATEST_LINES = """
latest_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem l) WHERE rn = 1
)"""

STORY_ROWS = rf"""
story_rows AS (
  SELECT l_orderkey || '-' || l_linenumber AS id,
    CAST(l_partkey AS INTEGER) AS rev,
    'Line ' || l_orderkey || '-' || l_linenumber AS title,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 3 THEN 'ORD-' || l_orderkey || ' '
         ELSE 'ORD-' || l_orderkey END AS client_id,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Removed' WHEN l_linestatus = 'F' THEN 'Closed'
         WHEN l_returnflag = 'N' THEN 'New' WHEN l_returnflag = 'A' THEN 'Active' END AS state,
    {_BOARD} AS board_column,
    CASE WHEN l_quantity > 40 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS story_points,
    p.area_path,
    'Delivery\' || year(l_shipdate) || '\S' || month(l_shipdate) AS iteration_path,
    CASE l_linenumber WHEN 2 THEN NULL WHEN 6 THEN '  ' ELSE l_returnflag || '; ' || l_linestatus END AS tags,
    CAST(l_linenumber % 4 + 1 AS INTEGER) AS priority,
    CAST(l_orderkey AS VARCHAR) AS parent_id,
    l_shipdate AS changed_date,
    'User Story' AS work_item_type,
    'Delivery' AS project,
    CASE WHEN l_linenumber % 2 = 0 THEN 'Moved' END AS reason,
    l_shipdate - INTERVAL 10 DAY AS created_date,
    'Author ' || l_suppkey % 10 AS created_by, 'Editor ' || l_partkey % 10 AS changed_by,
    CASE WHEN l_linenumber <> 5 THEN 'Dev ' || l_suppkey % 7 END AS assigned_to,
    '<p>Line <b>' || l_orderkey || '-' || l_linenumber || '</b></p>' AS description_html,
    CASE WHEN l_linenumber <> 4 THEN '<ul><li>' || CAST(l_quantity AS INTEGER) || '</li></ul>' END AS acceptance_criteria_html,
    l_linenumber = 6 AS board_column_done,
    l_shipdate - INTERVAL 1 DAY AS state_change_date,
    CASE WHEN l_returnflag <> 'N' THEN l_shipdate - INTERVAL 5 DAY END AS activated_date,
    CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS closed_date,
    'TT-' || l_suppkey % 5 AS time_tracking_project,
    CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_partkey % 100 AS VARCHAR) END AS time_tracking_product_id
  FROM {{lines}} LEFT JOIN paths p ON l_suppkey = p.s_suppkey
)"""

STORIES = rf"""
stories AS (
  SELECT *, trim(regexp_replace(description_html, '<[^>]+>', ' ', 'g')) AS description,
    trim(regexp_replace(acceptance_criteria_html, '<[^>]+>', ' ', 'g')) AS acceptance_criteria,
    string_split(area_path, '\')[-1] AS client, string_split(iteration_path, '\')[-1] AS sprint_name,
    coalesce(trim(state) IN ('Closed', 'Done', 'Removed'), false) AS is_closed,
    parent_id IS NOT NULL AS has_parent,
    coalesce(tags IS NOT NULL AND trim(tags) <> '', false) AS has_tags
  FROM story_rows
)"""

BASE = "WITH " + ",".join([CLIENT, PATHS, LATEST_LINES, STORY_ROWS.replace("{lines}", "latest_lines"), STORIES])
ALL_REVISIONS = "WITH " + ",".join([PATHS, STORY_ROWS.replace("{lines}", "lineitem"), STORIES])

MAPPED_SELECT = f"""
  SELECT i.jira_id, i.jira_name, i.project_name AS jira_project_name, i.issue_type AS jira_issue_type,
    i.status AS jira_status, i.description AS jira_description, i.reporter AS jira_reporter,
    i.assignee AS jira_assignee, i.priority AS jira_priority, i.story_points AS jira_story_points,
    i.parent_jira_id AS jira_parent_id, {_arr('i.release_names')} AS jira_fix_versions,
    {_arr('i.release_ids')} AS release_ids, {_arr('i.labels')} AS jira_labels,
    i.start_date AS jira_start_date, i.due_date AS jira_due_date,
    i.created AS jira_created_date, i.updated AS jira_updated_date, i.resolution AS jira_resolution,
    {_q(CLIENT_HOST + '/browse/')} || i.jira_id AS jira_url,
    coalesce(trim(i.status) IN ('Closed', 'Done', 'Resolved'), false) AS jira_is_closed,
    s.id AS ado_story_id, s.parent_id AS ado_parent_id, s.story_points AS ado_story_points,
    s.rev AS ado_revision, s.title AS ado_name, s.description AS ado_description,
    s.acceptance_criteria AS ado_acceptance_criteria, s.board_column AS ado_board_column,
    s.board_column_done AS ado_board_done, s.priority AS ado_priority, s.project AS ado_project,
    s.state AS ado_status, s.is_closed AS ado_is_closed, s.reason AS ado_reason,
    s.iteration_path AS ado_iteration, s.tags AS ado_tags, s.area_path AS internal_area,
    s.client AS internal_client, s.sprint_name AS sprint_name,
    s.time_tracking_project, s.time_tracking_product_id"""


def _mapped_cte(story_filter: str = "state <> 'Removed'") -> str:
    return (BASE + f""",
mapped AS ({MAPPED_SELECT}
  FROM issues i LEFT JOIN (SELECT * FROM stories WHERE {story_filter}) s ON trim(i.jira_id) = trim(s.client_id))""")


def _accepted(expr: str, mapping: dict[str, str]) -> str:
    norm = f"regexp_replace(trim(lower({expr})), '\\s+', ' ', 'g')"
    repl = "CASE " + " ".join(f"WHEN {norm} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items()) + f" ELSE {norm} END"
    targets = ", ".join(_q(t) for t in sorted(set(mapping.values())))
    return f"CASE WHEN ({repl}) IN ({targets}) THEN ({repl}) END"


UNIFIED = (f"coalesce({_accepted('ado_board_column', INTERNAL_STATUS_MAP)}, "
           f"{_accepted('jira_status', CLIENT_STATUS_MAP)}, 'uncategorised')")

# The mapped rows keep the arrays as lists for exploding.
_MAPPED_LISTS = (BASE + """,
mapped_l AS (
  SELECT i.jira_id, i.status AS jira_status, i.story_points AS jira_story_points,
    i.release_ids, i.release_names, s.id AS ado_story_id, s.story_points AS ado_story_points,
    s.board_column AS ado_board_column
  FROM issues i LEFT JOIN (SELECT * FROM stories WHERE state <> 'Removed') s ON trim(i.jira_id) = trim(s.client_id)
),
exploded AS (
  SELECT m.*, u.release_ids AS release_id, u.release_names AS release_name
  FROM mapped_l m, LATERAL (SELECT unnest(m.release_ids) AS release_ids,
                                   unnest(m.release_names) AS release_names) u
),
rows AS (
  SELECT *, coalesce(CAST(ado_story_points AS DOUBLE), CAST(jira_story_points AS DOUBLE)) AS effective_story_points,
    """ + UNIFIED + """ AS unified_state FROM exploded
)""")

ROLLUP = _MAPPED_LISTS + """,
rollup AS (
  SELECT release_id, release_name, sum(effective_story_points) AS story_point_total,
    CAST(count(jira_id) AS BIGINT) AS amount_of_work_items,
    CAST(count(*) FILTER (WHERE effective_story_points IS NULL) AS BIGINT) AS work_items_without_story_points,
    CAST(count(jira_id) AS BIGINT) AS total_work,
    """ + ",\n    ".join(f"CAST(count(*) FILTER (WHERE unified_state = '{s}') AS BIGINT) AS {s}" for s in UNIFIED_STATES) + f""",
    {_ts(c.AS_OF)} AS last_update
  FROM rows GROUP BY release_id, release_name
)"""

EVENTS_LATEST = """
SELECT * EXCLUDE (rn) FROM (
  SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events e
) WHERE rn = 1"""

CS = c.COMPOUND_START
T0, ID0 = _ts(CS["last_update_timestamp"]), CS["last_work_item_id"]


def _damaged() -> str:
    return ("CASE WHEN event_id % 50 = 0 THEN substring(props, 1, length(props) - 1) "
            "WHEN event_id % 70 = 0 THEN '{\"k\":\"x\"}' WHEN event_id % 90 = 0 THEN '{\"k\":null}' ELSE props END")


SQL: dict[str, str] = {
    "releases_rollup": ROLLUP + " SELECT * FROM rollup ORDER BY release_name NULLS FIRST",
    "mapped_items": _mapped_cte() + " SELECT * FROM mapped",
    "mapped_items_left_join": _mapped_cte() + " SELECT * FROM mapped",
    "mapped_items_keep_null_state": _mapped_cte("state IS DISTINCT FROM 'Removed'") + " SELECT * FROM mapped",
    "unmatched_items": BASE + """
      SELECT jira_id, jira_name, status, story_points FROM issues i
      WHERE NOT EXISTS (SELECT 1 FROM stories s WHERE s.state <> 'Removed' AND trim(s.client_id) = trim(i.jira_id))""",
    "unified_state_counts": _MAPPED_LISTS + f"""
      SELECT {UNIFIED} AS unified_state, CAST(count(*) AS BIGINT) AS n FROM mapped_l GROUP BY 1""",
    "effective_points": _MAPPED_LISTS + """
      SELECT jira_id, ado_story_id, jira_story_points, ado_story_points,
        coalesce(CAST(ado_story_points AS DOUBLE), CAST(jira_story_points AS DOUBLE)) AS effective_story_points
      FROM mapped_l""",
    "release_explode": _MAPPED_LISTS + " SELECT jira_id, ado_story_id, release_id, release_name FROM exploded",
    "release_explode_outer": _MAPPED_LISTS + """
      SELECT jira_id, ado_story_id, release_id, release_name FROM exploded
      UNION ALL
      SELECT jira_id, ado_story_id, NULL, NULL FROM mapped_l WHERE len(release_ids) = 0 OR release_ids IS NULL""",
    "release_state_long": _MAPPED_LISTS + """
      SELECT release_id, release_name, unified_state, CAST(count(jira_id) AS BIGINT) AS n
      FROM rows GROUP BY ALL""",
    "release_conservation": ROLLUP + """
      SELECT release_id, release_name, total_work,
        CAST(""" + " + ".join(UNIFIED_STATES) + """ AS BIGINT) AS state_sum,
        coalesce(total_work = (""" + " + ".join(UNIFIED_STATES) + """), false) AS balanced
      FROM rollup""",
    "quality_warn_counts": _mapped_cte() + """
      SELECT CAST(count(*) FILTER (WHERE ado_story_id IS NULL) AS BIGINT) AS missing_internal_story,
             CAST(count(*) FILTER (WHERE jira_id IS NULL) AS BIGINT) AS null_jira_id FROM mapped""",
    "enforced_releases": ROLLUP + " SELECT * FROM rollup ORDER BY release_name NULLS FIRST",
    "scd1_lineitem_max_by": "WITH " + LATEST_LINES + " SELECT * FROM latest_lines",
    "scd1_lineitem_row_number": "WITH " + LATEST_LINES + " SELECT * FROM latest_lines",
    "id_chunk_bodies": f"""
      SELECT CAST((rn - 1) // {c.CHUNK_SIZE} AS BIGINT) AS chunk_id, CAST(count(*) AS BIGINT) AS n_bodies,
        CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, max(o_orderdate) AS last_date
      FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1""",
    "project_listing": "SELECT DISTINCT event_type FROM events ORDER BY event_type",
    "ingest_stamps": """
      SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_unstamped, CAST(1 AS BIGINT) AS n_stamps,
        true AS recent FROM events""",
    "scd1_events_latest": EVENTS_LATEST,
    "scd1_two_queries_one_table": EVENTS_LATEST,
    "scd1_growing_table": "SELECT event_id, ts, user_id, event_type, value, props, true AS fits FROM events",
    "scd1_backfill_new_checkpoint": EVENTS_LATEST,
    "scd1_ties": """
      SELECT * EXCLUDE (rn) FROM (
        SELECT l.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, struct_pack(a := l_partkey, b := l_suppkey, c := l_extendedprice) DESC) AS rn
        FROM lineitem l) WHERE rn = 1""",
    "source_issue_feed": "WITH " + CLIENT + f"""
      SELECT CAST(k AS VARCHAR) AS jira_internal_id, project_key AS project, jira_id AS key, jira_name AS summary,
        issue_type, strftime(updated, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS updated,
        {_q(CLIENT_HOST + '/browse/')} || jira_id AS url, jira_id AS payload_key, true AS stamped
      FROM issues""",
    "source_story_feed": "WITH " + ",".join([PATHS, STORY_ROWS.replace("{lines}", "lineitem")]) + f"""
      SELECT 'internal' AS org, 'Delivery' AS project, id, CAST(rev AS VARCHAR) AS rev, title,
        {_q(INTERNAL_HOST + '/_workitems/edit/')} || id AS url, true AS stamped FROM story_rows""",
    "slice_time_inclusive": f"SELECT * FROM events WHERE ts >= {_ts(c.TIME_START)}",
    "slice_and_both": f"SELECT * FROM events WHERE ts >= {T0} AND event_id > {ID0}",
    "slice_keyset": f"SELECT * FROM events WHERE ts > {T0} OR (ts = {T0} AND event_id > {ID0})",
    "slice_bounded": f"SELECT * FROM events WHERE ts >= {_ts(c.BOUNDED[0])} AND ts < {_ts(c.BOUNDED[1])}",
    "next_offset": f"""
      SELECT event_type,
        coalesce(strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ'), {_q(CS['last_update_timestamp'])}) AS last_update_timestamp,
        coalesce(max(event_id), {ID0}) AS last_work_item_id, CAST(count(*) AS BIGINT) AS rows_read
      FROM events WHERE ts > {T0} OR (ts = {T0} AND event_id > {ID0}) GROUP BY event_type""",
    "next_offset_minute": f"""
      SELECT coalesce(strftime(date_trunc('minute', max(ts)), '%Y-%m-%d %H:%M'), {_q(c.TIME_START)}) AS last_update_timestamp,
        coalesce(max(event_id), 0) AS last_work_item_id, CAST(count(*) AS BIGINT) AS rows_read
      FROM events WHERE ts >= {_ts(c.TIME_START)}""",
    "slice_local_zone": f"""
      SELECT event_id, ts, strftime(timezone({_q(c.LOCAL_ZONE)}, timezone('UTC', ts)), '%Y-%m-%d %H:%M') AS local_minute
      FROM events WHERE ts >= {_ts(c.TIME_START)}""",
    "slice_local_zone_safe": f"""
      SELECT event_id, ts, strftime(CASE WHEN epoch(l) - epoch(b) < 3600 OR epoch(a) - epoch(l) < 3600 THEN b ELSE l END,
                                    '%Y-%m-%d %H:%M') AS safe_local_minute
      FROM (SELECT event_id, ts, timezone({_q(c.LOCAL_ZONE)}, timezone('UTC', ts)) AS l,
                   timezone({_q(c.LOCAL_ZONE)}, timezone('UTC', ts - INTERVAL 1 HOUR)) AS b,
                   timezone({_q(c.LOCAL_ZONE)}, timezone('UTC', ts + INTERVAL 1 HOUR)) AS a
            FROM events WHERE ts >= {_ts(c.TIME_START)})""",
    "local_zone_clock_change": f"""
      SELECT event_id, ts, strftime(l, '%Y-%m-%d %H:%M') AS local_minute,
        strftime(CASE WHEN epoch(l) - epoch(b) < 3600 OR epoch(a) - epoch(l) < 3600 THEN b ELSE l END,
                 '%Y-%m-%d %H:%M') AS safe_local_minute
      FROM (SELECT event_id, ts, timezone({_q(c.LOCAL_ZONE)}, timezone('UTC', ts)) AS l,
                   timezone({_q(c.LOCAL_ZONE)}, timezone('UTC', ts - INTERVAL 1 HOUR)) AS b,
                   timezone({_q(c.LOCAL_ZONE)}, timezone('UTC', ts + INTERVAL 1 HOUR)) AS a
            FROM (SELECT event_id, ts + INTERVAL 285 DAY AS ts FROM events))""",
    "project_list_filter": """
      SELECT event_type, CAST(count(*) AS BIGINT) AS n, max(event_id) AS max_event_id FROM events
      WHERE event_type IN ('view', 'click', 'purchase') GROUP BY event_type""",
    "type_filter_slice": f"""
      SELECT event_id, ts, user_id, value FROM events
      WHERE ts >= {_ts(c.TIME_START)} AND event_type = {_q(c.TYPE_FILTER)} ORDER BY ts, event_id""",
    "id_chunks": f"""
      SELECT CAST((rn - 1) // {c.CHUNK_SIZE} AS BIGINT) AS chunk_id, CAST(count(*) AS BIGINT) AS n_ids,
        min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
      FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1""",
    "envelope_json": "WITH " + CLIENT + f"""
      SELECT CAST(k AS VARCHAR) AS jira_internal_id, project_key AS project, jira_id AS key, jira_name AS summary,
        issue_type, strftime(updated, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS updated,
        {_q(CLIENT_HOST + '/browse/')} || jira_id AS url, {_ts(c.AS_OF)} AS extraction_timestamp,
        jira_id AS payload_key, status AS payload_status, CAST(story_points AS VARCHAR) AS payload_points
      FROM issues""",
    "ingest_stamp": f"SELECT event_id, user_id, event_type, {_ts(c.AS_OF)} AS extraction_timestamp FROM events",
    "variant_extract_typed": """
      SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.k') AS k_text,
        CAST(json_extract(props, '$.k') AS DOUBLE) AS k_double, CAST(NULL AS VARCHAR) AS missing FROM events""",
    "variant_arrays": "WITH " + CLIENT + f"""
      SELECT jira_id, {_arr('release_ids')} AS fix_version_ids, {_arr('release_names')} AS fix_version_names,
        {_arr('labels')} AS labels, CAST(len(release_ids) AS INTEGER) AS n_versions, story_points,
        created AS created_date, coalesce(trim(status) IN ('Closed', 'Done', 'Resolved'), false) AS is_closed,
        parent_jira_id IS NOT NULL AS has_parent
      FROM issues""",
    "variant_dotted_path": ALL_REVISIONS + """
      SELECT id, rev, state, board_column, story_points, client_id, changed_date, priority, parent_id, work_item_type
      FROM stories""",
    "variant_lenient": f"""
      SELECT event_id, json_valid(p) AS parsed,
        CASE WHEN json_valid(p) THEN TRY_CAST(json_extract_string(p, '$.k') AS INTEGER) END AS k,
        CASE WHEN json_valid(p) AND json_extract_string(p, '$.k') IS NOT NULL
              AND TRY_CAST(json_extract_string(p, '$.k') AS INTEGER) IS NULL THEN 1 ELSE 0 END AS cast_failed
      FROM (SELECT event_id, {_damaged()} AS p FROM events)""",
    "strip_markup": """
      SELECT page_id, trim(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS text,
        CAST(length(trim(regexp_replace(html, '<[^>]+>', ' ', 'g'))) AS INTEGER) AS n_chars FROM pages""",
    "path_levels": "WITH " + PATHS + r"""
      SELECT s_suppkey, area_path, string_split(area_path, '\')[1] AS area_level_1,
        string_split(area_path, '\')[2] AS area_level_2, string_split(area_path, '\')[3] AS area_level_3,
        string_split(area_path, '\')[-1] AS client FROM paths""",
    "stream_bronze_append": "SELECT * FROM events",
    "source_partitioned": f"SELECT * FROM events WHERE ts >= {_ts(c.TIME_START)}",
    "scd1_events_foreach_batch": EVENTS_LATEST,
    "scd1_events_stream_state": EVENTS_LATEST,
    "scd1_replay_idempotent": EVENTS_LATEST,
    "end_to_end_refresh": ROLLUP + " SELECT * FROM rollup ORDER BY release_name NULLS FIRST",
    "releases_latest_name": _MAPPED_LISTS + f""",
agg AS (
  SELECT release_id, max(release_name) AS release_name, sum(effective_story_points) AS story_point_total,
    CAST(count(jira_id) AS BIGINT) AS amount_of_work_items,
    CAST(count(*) FILTER (WHERE effective_story_points IS NULL) AS BIGINT) AS work_items_without_story_points,
    CAST(count(jira_id) AS BIGINT) AS total_work,
    """ + ",\n    ".join(f"CAST(count(*) FILTER (WHERE unified_state = '{s}') AS BIGINT) AS {s}" for s in UNIFIED_STATES) + f""",
    CAST(count(DISTINCT trim(jira_id)) AS BIGINT) AS distinct_work_items,
    {_ts(c.AS_OF)} AS last_update
  FROM rows GROUP BY release_id)
SELECT * FROM agg""",
    "silver_issues_current": "WITH " + CLIENT + f"""
      SELECT CAST(k AS VARCHAR) AS jira_internal_id, jira_id, jira_name, project_key, project_name, issue_type,
        status, description, reporter, assignee, priority,
        story_points, parent_jira_id, {_arr('release_names')} AS fix_versions, {_arr('release_ids')} AS fix_version_ids,
        {_arr('labels')} AS labels, start_date, due_date, created AS created_date,
        updated AS updated_date, resolution, {_q(CLIENT_HOST + '/browse/')} || jira_id AS url,
        {_ts(c.AS_OF)} AS extraction_timestamp,
        coalesce(trim(status) IN ('Closed', 'Done', 'Resolved'), false) AS is_closed,
        parent_jira_id IS NOT NULL AS has_parent
      FROM issues""",
    "silver_stories_current": BASE + rf"""
      SELECT id, rev, title, {_q(INTERNAL_HOST + '/_workitems/edit/')} || id AS url, 'internal' AS org, project,
        work_item_type, state, reason, area_path, iteration_path,
        created_date, changed_date, created_by,
        changed_by, assigned_to, parent_id, tags,
        description_html, acceptance_criteria_html,
        board_column, board_column_done, priority, story_points,
        state_change_date, activated_date,
        closed_date, time_tracking_project,
        time_tracking_product_id, client_id, {_ts(c.AS_OF)} AS extraction_timestamp,
        description, acceptance_criteria, client, sprint_name,
        string_split(area_path, '\')[1] AS area_level_1, string_split(area_path, '\')[2] AS area_level_2,
        string_split(area_path, '\')[3] AS area_level_3, string_split(iteration_path, '\')[1] AS iteration_level_1,
        string_split(iteration_path, '\')[2] AS iteration_level_2,
        string_split(iteration_path, '\')[3] AS iteration_level_3, is_closed, has_parent, has_tags
      FROM stories""",
    "stored_variant_paths": BASE + """
      SELECT id, state AS payload_state, client_id AS payload_client_id, rev AS payload_rev FROM stories""",
    "gold_views_written": ROLLUP + " SELECT * FROM rollup",
    "quality_rule_runs": "SELECT 'mapped_items' AS view, CAST(0 AS BIGINT) AS version, 'story_found' AS rule,"
    " 'warn' AS action, rows, broken, 'written' AS outcome FROM (" + _mapped_cte() + """
      SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE ado_story_id IS NULL) AS BIGINT) AS broken
      FROM mapped)
      UNION ALL SELECT 'releases', 0, 'states_add_up', 'fail', n, 0, 'written' FROM (""" + ROLLUP + """
      SELECT CAST(count(*) AS BIGINT) AS n FROM rollup)""",
    "releases_update_time": ROLLUP + """
      SELECT CAST(count(*) AS BIGINT) AS n_releases, CAST(1 AS BIGINT) AS n_times, true AS since_begin,
        true AS before_end FROM rollup""",
    "closed_parent_tag_flags": BASE + " SELECT id, state, is_closed, has_parent, has_tags, tags FROM stories",
}
