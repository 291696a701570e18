"""Times without a zone: as instants, and between zones. The session's time zone plays no part.

Wall-clock times that a zone skips in spring are taken with the offset before the gap (02:30 is what 03:30 shows); times
that it has twice in autumn are the first of the two. Null times stay null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(naive: Column) -> Column:
    """Microseconds since 1970 of a time without a zone that is meant in UTC."""
    seconds = (naive.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("long")


def as_utc(naive: Column) -> Column:
    """The instant of a time without a zone that is meant in UTC."""
    return F.timestamp_micros(micros(naive))


def to_utc(naive: Column, zone: str | Column) -> Column:
    """The time in UTC, without a zone, of a wall clock in ``zone``."""
    source = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(source, F.lit("UTC"), naive.cast("timestamp_ntz"))


def in_zone(naive: Column, zone: str | Column) -> Column:
    """What a wall clock in ``zone`` shows at a time that is meant in UTC."""
    target = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), target, naive.cast("timestamp_ntz"))
