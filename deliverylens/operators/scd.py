"""Latest row per key (slowly changing dimension, type 1).

The change flow keeps, for every key, the row with the highest sequence;
late rows with a lower sequence lose, repeated rows collapse. The sequence is
a list of columns compared left to right with NULL lowest (struct ordering),
so a row whose first sequence field is NULL loses to any non-null one and
still wins when it is alone.

Equal sequences have no defined winner in a plain change flow; pass
``tie_break`` (for example :func:`payload_hash`) to make the result
deterministic.

Two batch forms, both reduced on the map side before the shuffle, so a key
holding a third of all rows is pre-collapsed per input partition instead of
landing whole in one task:

* ``max_by``      ``groupBy(keys).agg(max_by(struct(row), struct(seq)))``: partial
                  aggregation per map task, then the final merge per key.
* ``row_number``  ``row_number() over (partition by keys order by seq desc) = 1``:
                  Spark inserts a partial ``WindowGroupLimit`` before the exchange.

Both accept VARIANT columns in the row (``max(struct)`` would not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METHODS = ("max_by", "row_number")


def payload_hash(*cols: str) -> Column:
    """Deterministic last-resort tie-break: 64-bit hash of the given columns."""
    return F.xxhash64(*[F.col(c).cast("string") for c in cols])


def sequence_struct(sequence: list[str | Column], tie_break: Column | None = None) -> Column:
    parts = [F.col(s) if isinstance(s, str) else s for s in sequence]
    if tie_break is not None:
        parts.append(tie_break)
    return F.struct(*[p.alias(f"_s{i}") for i, p in enumerate(parts)])


def latest_per_key(df: DataFrame, keys: list[str], sequence: list[str | Column],
                   method: str = "row_number", tie_break: Column | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``sequence`` (see module doc).

    The output has the input's columns in the input's order.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    cols = df.columns
    if method == "max_by":
        value_cols = [c for c in cols if c not in keys]
        reduced = df.groupBy(*keys).agg(
            F.max_by(F.struct(*value_cols), sequence_struct(sequence, tie_break)).alias("_latest"))
        return reduced.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in value_cols]).select(*cols)
    order = sequence_struct(sequence, tie_break)
    w = Window.partitionBy(*keys).orderBy(order.desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
