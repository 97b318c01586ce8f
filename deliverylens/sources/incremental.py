"""Incremental reads over a change table with explicit offsets.

Three slice forms, all plain filters that reach the Parquet scan as pushed
predicates:

* ``time``      ``ts >= start`` (inclusive, minute precision). Consecutive
                reads overlap on the boundary minute; the keyed upsert removes
                the repeats, so an at-least-once read has an exactly-once effect.
* ``and_both``  ``ts >= t AND id > i``: the compound predicate as the
                reference issues it. After the first read an edit to an item
                whose id is at or below the offset id is never read again.
* ``keyset``    ``ts > t OR (ts = t AND id > i)``: the lexicographic (time, id)
                successor, which does not lose edits to known ids (default).

``bounded`` is the recovery read between two offsets, half open and
deterministic (the reference ignores its end bound).

Offsets come from the data (:func:`next_offset`): the greatest change time and
id read, else the start offset unchanged, so an empty read never advances.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import ISO_Z_FORMAT, MINUTE_FORMAT, floor_minute
from .changefeed import project_names  # noqa: F401  (option parsing shared with the stream source)

MODES = ("and_both", "keyset")


def offset_ts(text: str) -> Column:
    """Offset text (``yyyy-MM-dd HH:mm`` or ISO-8601 ``...Z``) as TIMESTAMP_NTZ."""
    return F.to_timestamp_ntz(F.lit(text.replace("T", " ").rstrip("Z")))


def slice_time(df: DataFrame, start: str, ts_col: str = "ts") -> DataFrame:
    return df.filter(F.col(ts_col) >= offset_ts(start))


def slice_compound(df: DataFrame, start: dict, ts_col: str = "ts", id_col: str = "event_id",
                   mode: str = "keyset") -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    t = offset_ts(start["last_update_timestamp"])
    i = F.lit(int(start["last_work_item_id"]))
    ts, idc = F.col(ts_col), F.col(id_col)
    if mode == "and_both":
        return df.filter((ts >= t) & (idc > i))
    return df.filter((ts > t) | ((ts == t) & (idc > i)))


def slice_bounded(df: DataFrame, start: str, end: str, ts_col: str = "ts") -> DataFrame:
    """Rows with ``start <= ts < end``: a replay returns exactly the rows of the
    original read."""
    return df.filter((F.col(ts_col) >= offset_ts(start)) & (F.col(ts_col) < offset_ts(end)))


def next_offset(read: DataFrame, start: dict, ts_col: str = "ts", id_col: str = "event_id",
                group_cols: list[str] | None = None, minute: bool = False) -> DataFrame:
    """The offset after ``read``: greatest change time (ISO Z text, or minute
    text when ``minute``) and greatest id, falling back to the start values
    when nothing was read. One row per ``group_cols`` value (per project), or
    one row overall. A single partial+final aggregation."""
    group_cols = group_cols or []
    max_ts = F.max(ts_col)
    ts_text = F.date_format(floor_minute(max_ts), MINUTE_FORMAT) if minute else F.date_format(max_ts, ISO_Z_FORMAT)
    aggs = [
        F.coalesce(ts_text, F.lit(start["last_update_timestamp"])).alias("last_update_timestamp"),
        F.coalesce(F.max(id_col), F.lit(int(start.get("last_work_item_id", 0))).cast("bigint"))
         .alias("last_work_item_id"),
        F.count(F.lit(1)).alias("rows_read"),
    ]
    return read.groupBy(*group_cols).agg(*aggs)


def project_filter(df: DataFrame, option: str | None, project_col: str) -> DataFrame:
    projects = project_names(option)
    return df if projects is None else df.filter(F.col(project_col).isin(projects))


def id_chunks(df: DataFrame, id_col: str, chunk_size: int, stage_path: str) -> DataFrame:
    """Consecutive chunks of ``chunk_size`` ids in ascending id order, as
    ``chunk = floor((rank - 1) / chunk_size)``, without a global single-task
    window:

    1. range-partition and sort the ids; inside a partition the position is
       ``monotonically_increasing_id() - (partition_id << 33)``;
    2. write that once below the shared folder (stable partition ids);
    3. per-partition counts -> running offsets: one row per partition, a
       bounded table, broadcast back;
    4. rank = offset + position.
    """
    sc = df.sparkSession
    n = max(1, df.rdd.getNumPartitions(), sc.sparkContext.defaultParallelism)
    pid = F.spark_partition_id()
    # ``_tb`` (a hash of the row's scan position) breaks ties between copies of
    # one id, so the range partitioner can split even an id value that holds a
    # third of all rows; copies are interchangeable in the ranking.
    ids = df.select(F.col(id_col)).withColumn("_tb", F.xxhash64(F.monotonically_increasing_id()))
    staged = (ids.repartitionByRange(n, id_col, "_tb").sortWithinPartitions(id_col, "_tb")
              .withColumn("_pid", pid)
              .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)))
    staged.write.mode("overwrite").parquet(stage_path)
    staged = sc.read.parquet(stage_path)
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    ranked = staged.join(F.broadcast(offsets.select("_pid", "_offset")), "_pid")
    rank = F.col("_offset") + F.col("_pos")  # 0-based
    return ranked.select(F.col(id_col), F.floor(rank / chunk_size).cast("bigint").alias("chunk_id"))


def chunk_bodies(chunks: DataFrame, bodies: DataFrame, id_col: str) -> DataFrame:
    """Second read step: the bodies of the listed ids with the chunk that asks
    for each. An id listed more than once is read by the first chunk that names
    it, also where its copies lie in two chunks. The list and the bodies meet in
    a join on the executors, where AQE may split an id that holds many rows."""
    listed = chunks.groupBy(id_col).agg(F.min("chunk_id").alias("chunk_id"))
    return bodies.join(listed, id_col)


def list_projects(df: DataFrame, project_col: str) -> DataFrame:
    """Every project that the feed names, for an option that asks for all of them."""
    return df.where(F.col(project_col).isNotNull()).select(project_col).distinct()
