"""Time expressions. The session time zone is pinned to UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.text import _col

MICROS_PER_DAY = 86_400_000_000


def from_unix_text(c: Column | str, lenient: bool = False) -> Column:
    """Unix seconds held as text to a timestamp; bad input raises, or gives NULL when lenient."""
    seconds = _col(c).try_cast("bigint") if lenient else _col(c).cast("bigint")
    return F.timestamp_seconds(seconds)


def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    return F.to_timestamp(_col(c), fmt) if fmt else F.to_timestamp(_col(c))


def unix_seconds(c: Column | str) -> Column:
    return F.unix_seconds(_col(c).cast("timestamp"))


def posting_hour(c: Column | str) -> Column:
    return F.hour(_col(c))


def weeks_to(anchor: dt.date, c: Column | str) -> Column:
    """Whole weeks from the row's time to the anchor's midnight; negative after it.

    Days are floored on the exact time difference first, so half a day before the anchor is day 0.
    """
    at = F.lit(dt.datetime(anchor.year, anchor.month, anchor.day)).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", _col(c).cast("timestamp_ntz"), at)
    return F.floor(F.floor(micros / F.lit(MICROS_PER_DAY)) / F.lit(7))


def weeks_between(anchor: dt.date, day: dt.date) -> int:
    """The same rule for two dates on the driver."""
    return (anchor - day).days // 7
