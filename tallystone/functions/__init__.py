"""Scalar functions: sizes, times and rates as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_size(n: Column, base: int = 1024) -> Column:
    """One decimal and B, KB, MB, GB or TB."""
    out = F.format_string("%.1fB", n.cast("double"))
    for power, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(n >= base**power, F.format_string(f"%.1f{unit}", n / float(base**power))).otherwise(out)
    return out


def format_timestamp(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd HH:mm:ss")


def format_throughput(megabytes: Column, seconds: Column) -> Column:
    return F.when(seconds == 0, "∞ MB/s").otherwise(F.format_string("%.1f MB/s", megabytes / seconds))


def percent(part: Column, whole: Column) -> Column:
    """Two decimals; null if the whole is 0."""
    return F.round(F.try_divide(100.0 * part, whole), 2)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))
