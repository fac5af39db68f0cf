"""Run dates, weekend roll and feed timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .safe import _col

SUNDAY, SATURDAY = 1, 7


def run_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """Date from its parts; null for a null part or a day the month does not have."""
    text = F.concat(*[p.cast("string") for p in
                      (_col(year), F.lit("-"), _col(month), F.lit("-"), _col(day))])
    return text.try_cast("date")


def run_date_parts(date: Column | str) -> dict[str, Column]:
    """Landing keys of a date: four-digit year, two-digit month and day."""
    d = _col(date)
    return {
        "year": F.date_format(d, "yyyy"),
        "month": F.date_format(d, "MM"),
        "day": F.date_format(d, "dd"),
    }


def weekend_roll(date: Column | str) -> Column:
    """Saturday and Sunday move to Monday; there is no holiday calendar."""
    d = _col(date)
    weekday = F.dayofweek(d)
    return (
        F.when(weekday == SUNDAY, F.date_add(d, 1))
        .when(weekday == SATURDAY, F.date_add(d, 2))
        .otherwise(d)
    )


def parse_feed_time(text: Column | str) -> Column:
    """Timestamp of ``Wed, 29 Apr 2026 07:00:00 GMT``; the weekday carries no information."""
    without_weekday = F.substring_index(_col(text), ", ", -1)
    return F.try_to_timestamp(without_weekday, F.lit("d MMM yyyy HH:mm:ss z"))


def in_run_window(ts: Column | str, run: Column, days_before: int, days_after: int) -> Column:
    """Half-open range around a run date; plain comparisons, so that a scan can use them."""
    t = _col(ts)
    start = F.date_sub(run, days_before).cast("timestamp")
    end = F.date_add(run, days_after).cast("timestamp")
    return (t >= start) & (t < end)
