"""Timestamps, day windows and offsets from the fact-check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso_offset(c) -> Column:
    c = _column(c)
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXX")),
    )


def parse_cut_fraction(c) -> Column:
    """ISO time whose fraction and zone mark are cut at the dot."""
    whole = F.regexp_replace(F.split(_column(c), r"\.")[0], "Z$", "")
    return F.try_to_timestamp(whole, F.lit("yyyy-MM-dd'T'HH:mm:ss"))


def parse_day_first(c) -> Column:
    return F.try_to_timestamp(_column(c), F.lit("dd/MM/yyyy"))


def parse_day_first_time(c) -> Column:
    return F.try_to_timestamp(_column(c), F.lit("dd/MM/yyyy HH:mm:ss"))


def parse_year_first(c) -> Column:
    return F.try_to_timestamp(_column(c), F.lit("yyyy/MM/dd"))


def from_epoch(c, zone: str | None = None) -> Column:
    """Epoch seconds as an instant, or as wall-clock time in a zone."""
    instant = F.timestamp_seconds(_column(c).cast("bigint"))
    return F.from_utc_timestamp(instant, zone) if zone else instant


def day(c) -> Column:
    return F.to_date(_column(c))


def day_text(c) -> Column:
    return F.date_format(_column(c), "yyyy-MM-dd")


def add_days(c, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return _column(c) + F.make_dt_interval(days=n)


def day_windows(date, before: int = 7, after: int = 7, from_midnight: bool = True) -> Column:
    """Half-open one-day windows around a date.

    From midnight the last day is included (before + after + 1 windows); the
    other form starts at the claim's own time and has before + after windows.
    """
    date = _column(date)
    base = F.date_trunc("day", date) if from_midnight else date.cast("timestamp")
    last = after if from_midnight else after - 1
    return F.transform(
        F.sequence(F.lit(-before), F.lit(last)),
        lambda i: F.struct(
            (base + F.make_dt_interval(days=i)).alias("start"),
            (base + F.make_dt_interval(days=i + 1)).alias("end"),
        ),
    )


def day_offset(moment, checked) -> Column:
    return F.coalesce(F.datediff(_column(moment), _column(checked)), F.lit(0))


def hour_offset(moment, checked) -> Column:
    """Whole hours from the fact-check, rounded down; 0 when unknown."""
    seconds = F.unix_micros(_column(moment).cast("timestamp")) - F.unix_micros(
        _column(checked).cast("timestamp")
    )
    return F.coalesce(F.floor(seconds / F.lit(3_600_000_000)), F.lit(0)).cast("bigint")


def impact(offset, form: str = "hour") -> Column:
    """'Before/fact-check' or 'After'; the day form counts day 0 as before."""
    offset = _column(offset)
    early = offset < 0 if form == "hour" else offset <= 0
    return F.when(early, "Before/fact-check").otherwise("After")
