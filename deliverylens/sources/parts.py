"""Work on a table in parts, so that what is shuffled at once does not grow with it.

A part holds all rows of the keys that hash to it. Each part is reduced or joined
by jobs of its own, whose shuffle files go as soon as what they made is written, and the
parts together are the table: on disk are the result and the shuffles of one part,
not those of the whole table. A key that holds more rows than a part may is one
larger part. Tables of up to ``ROWS_PER_PART`` rows are one part.
"""

from __future__ import annotations

import math
from contextlib import AbstractContextManager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import setting

#: Rows that are shuffled at once; every further part reads the input once more.
ROWS_PER_PART = 12_000_000
#: Number of a part, and how many there are.
Part = tuple[int, int]

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def parts_for(rows: int) -> list[Part]:
    """The parts in which a table of ``rows`` rows is worked on."""
    n = max(1, math.ceil(rows / ROWS_PER_PART))
    return [(k, n) for k in range(n)]


def part_number(key: Column, parts: int) -> Column:
    """The part of a row by its key; rows without a key are in one part."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def in_part(key: Column, part: Part | None) -> Column:
    """Whether a row with this key is in ``part``; all are if there is one part or none is named."""
    return F.lit(True) if part is None or part[1] == 1 else part_number(key, part[1]) == part[0]


def shuffles_dropped(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries started inside remove their shuffle files when they end, not when the driver's memory is next
    cleared. For writes: a DataFrame that is run again would have to shuffle again."""
    return setting(spark, _DROP_SHUFFLES, "true")
