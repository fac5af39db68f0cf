"""Joins to sparse and global series, and the size check before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .pick import Keys, as_list

# A daily calendar of 547 years, some 5 MB.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_TEXT = 64 << 20  # bytes in all text columns

CALENDAR = ("0001-01-01", "9999-12-31")
FIXED_WIDTH = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date",
               "timestamp", "timestamp_ntz"}


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
             max_text: int = MAX_BROADCAST_TEXT) -> bool:
    """Whether ``df`` has at most so many rows and bytes of text; rows beyond are not counted."""
    texts = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0))
             for c, kind in df.dtypes if kind == "string"]
    rows, size = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)), F.coalesce(F.sum(sum(texts, F.lit(0)).cast("bigint")), F.lit(0))).first()
    return rows <= max_rows and size <= max_text


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after counting that it is small.

    Beyond the limit the side stays unmarked, and Spark joins by sort-merge with skew handling.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def join_snapshots(series: DataFrame, snapshots: DataFrame,
                   keys: Keys = ("ticker", "date")) -> DataFrame:
    """Left join on exactly equal key and date: a snapshot off the series' dates is lost.

    Both sides are unique on the keys, so no key is hot. Both come out of a deduplication on the
    same keys, or on the first one alone (``clean.gathered``), so a sort-merge join adds no shuffle.
    No hint: Spark checks the sizes.
    """
    return series.join(snapshots, on=as_list(keys), how="left")


def _by_day(side: DataFrame, on: str) -> DataFrame:
    """A side of at most one row per day, marked for broadcast where its type bounds its size.

    Dates of four-digit years are 3,652,059, and fixed-width columns take 8 bytes each at most, so
    such a side needs no count. Days of other years, which no series here has, match nothing.
    Sides with texts or other orders stay unmarked, and Spark compares sizes.
    """
    kinds = dict(side.dtypes)
    if kinds[on] != "date" or not all(k in FIXED_WIDTH or k.startswith("decimal")
                                      for k in kinds.values()):
        return side
    first, last = (F.lit(d).cast("date") for d in CALENDAR)
    return F.broadcast(side.filter(F.col(on).between(first, last)))


def join_global(series: DataFrame, values: DataFrame, on: str = "date") -> DataFrame:
    """Left join of a series that holds for all keys, at most one row per day."""
    return series.join(_by_day(values, on), on=on, how="left")


def trading_days_only(series: DataFrame, benchmark: DataFrame, on: str = "date") -> DataFrame:
    """Rows of days on which the benchmark has a row."""
    days = benchmark.select(on).distinct()
    return series.join(_by_day(days, on), on=on, how="left_semi")
