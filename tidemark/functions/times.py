"""Time expressions that do not depend on the session time zone.

Instants are ``TIMESTAMP``; wall-clock times are ``TIMESTAMP_NTZ`` in a stated zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"
CREATED_AT_FORMAT = "MMM dd HH:mm:ss Z yyyy"
NEW_YORK = "America/New_York"


def utc_instant(ntz: Column) -> Column:
    """Instant of a wall-clock time that is meant as UTC.

    A plain cast, and time differences too, would read it in the session zone.
    """
    return F.concat(ntz.cast("string"), F.lit("+00:00")).cast("timestamp")


def utc_wall_clock(ts: Column) -> Column:
    """UTC wall-clock time of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(EPOCH_NTZ))


def wall_text(ntz: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock time."""
    return F.substring(ntz.cast("string"), 1, 19)


def parse_created_at(created_at: Column) -> Column:
    """Instant of ``Wed Sep 16 20:00:01 +0000 2015``; null when it does not parse."""
    return F.try_to_timestamp(
        F.substring(created_at, F.lit(5), F.length(created_at)), F.lit(CREATED_AT_FORMAT)
    )


def floor_interval(ts: Column, seconds: int = 30) -> Column:
    """Start of the interval holding the instant, in epoch seconds."""
    epoch = F.unix_seconds(ts)
    return epoch - F.pmod(epoch, F.lit(seconds).cast("long"))


def to_local(ts: Column, zone: str = NEW_YORK) -> Column:
    """Wall-clock time of an instant in ``zone``, daylight saving included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall_clock(ts))


def time_of_day(ntz: Column) -> Column:
    """``HH:mm:ss`` of a wall-clock time."""
    return F.substring(ntz.cast("string"), 12, 8)
