"""Time helpers for incremental reads.

Offsets are stored as text. The time-watermark form uses minute precision
(``yyyy-MM-dd HH:mm``, UTC); the compound form uses ISO-8601 with a ``Z``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offset text formats.
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def floor_minute(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("minute", c)


def minute_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, MINUTE_FORMAT)


def utc_to_local_wall_clock(c: Column | str, zone: str) -> Column:
    """UTC instant -> wall-clock text of ``zone`` at minute precision, the form
    a tracker that filters by its user's local time expects."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(F.from_utc_timestamp(c, zone), MINUTE_FORMAT)


def safe_local_start(c: Column | str, zone: str) -> Column:
    """Local wall-clock start bound that never starts late.

    In the hour that repeats when clocks go back, one local text names two
    instants, and a tracker may read it as the later one; changes between the
    two would be skipped. When the instant's local text is ambiguous (a
    neighbouring instant within an hour maps to a wall clock less than an hour
    away), the bound moves one hour earlier; the inclusive re-read overlap is
    removed by the keyed upsert downstream."""
    c = F.col(c) if isinstance(c, str) else c
    hour = F.expr("INTERVAL 1 HOUR")
    local = F.from_utc_timestamp(c, zone)
    before = F.from_utc_timestamp(c - hour, zone)
    after = F.from_utc_timestamp(c + hour, zone)
    secs = F.unix_seconds
    ambiguous = ((secs(local) - secs(before)) < 3600) | ((secs(after) - secs(local)) < 3600)
    return F.date_format(F.when(ambiguous, before).otherwise(local), MINUTE_FORMAT)
