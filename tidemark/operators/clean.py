"""Raw feeds to typed, deduplicated tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_feed_time, run_date, weekend_roll
from ..functions.safe import to_date, to_double, to_long, to_measure
from ..schemas import DOUBLE_METRICS, LONG_METRICS
from .pick import Keys, as_list, keep_first

PRICE_FIELDS = ("open", "high", "low", "close")


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """The absent columns by name; no job runs."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """``df`` itself, or an error naming the absent columns before any job runs."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def column_report(tables: Mapping[str, DataFrame], required: Iterable[str]) -> DataFrame:
    """(name, missing, rows) of each table: what it lacks, else how many rows it brings.

    Tables that lack a column are not read.
    """
    needed = list(required)

    def row(name: str, df: DataFrame) -> DataFrame:
        absent = missing_columns(df, needed)
        if not absent:
            return df.groupBy().agg(F.lit(name).alias("name"), F.lit("").alias("missing"),
                                    F.count(F.lit(1)).alias("rows"))
        none = F.lit(None).cast("bigint").alias("rows")
        return df.sparkSession.range(1).select(
            F.lit(name).alias("name"), F.lit(", ".join(absent)).alias("missing"), none)

    return reduce(DataFrame.unionByName, [row(*t) for t in tables.items()])


def clean_profiles(raw: DataFrame) -> DataFrame:
    return raw.select(
        "ticker", "company_name",
        F.lower("sector").alias("sector"), F.lower("industry").alias("industry"),
    )


def clean_prices(raw: DataFrame) -> DataFrame:
    """Text columns ``Date, Open, High, Low, Close, Volume`` to typed prices.

    The row's own date counts, not the one in its path.
    """
    return raw.select(
        "ticker", to_date("Date").alias("date"),
        *[to_double(f.capitalize()).alias(f) for f in PRICE_FIELDS],
        to_long("Volume").alias("volume"),
    )


def gathered(df: DataFrame, by: Keys) -> DataFrame:
    """Rows moved by ``by``, where what follows groups by these columns or more; without any, ``df``."""
    return df.repartition(*as_list(by)) if by else df


def union_prices(historical: DataFrame, daily: DataFrame, by: Keys = ()) -> DataFrame:
    """Both price feeds, one row per ticker and date; the daily feed wins. For ``by`` see ``gathered``."""
    both = historical.withColumn("_feed", F.lit(0)).unionByName(
        daily.withColumn("_feed", F.lit(1)), allowMissingColumns=True
    )
    # The feed decides; the values after it only settle two rows of one feed.
    order = [F.col(c).desc_nulls_last() for c in ("_feed", "volume", *PRICE_FIELDS[::-1])]
    return keep_first(gathered(both, by), ["ticker", "date"], order).drop("_feed")


def dated(raw: DataFrame) -> DataFrame:
    """Adds ``raw_date`` from year, month and day, and ``date``, rolled off the weekend."""
    return raw.withColumn("raw_date", run_date("year", "month", "day")).withColumn(
        "date", weekend_roll("raw_date")
    )


def cast_metrics(raw: DataFrame) -> DataFrame:
    present = set(raw.columns)
    casts: dict[str, Column] = {m: to_measure(m) for m in DOUBLE_METRICS if m in present}
    casts |= {m: to_long(m) for m in LONG_METRICS if m in present}
    return raw.withColumns(casts)


def clean_metrics(raw: DataFrame, precedence: Sequence[str] = (), by: Keys = ()) -> DataFrame:
    """Weekly snapshots, one row per ticker and rolled date.

    Of the snapshots that roll onto one Monday the one with the latest own date stays, then the
    highest by ``precedence`` (columns that are dropped afterwards), then by value. For ``by`` see
    ``gathered``.
    """
    typed = gathered(cast_metrics(dated(raw)), by)
    values = [m for m in DOUBLE_METRICS + LONG_METRICS if m in typed.columns]
    order = [F.col(c).desc_nulls_last() for c in ("raw_date", *precedence, *values)]
    return keep_first(typed, ["ticker", "date"], order).select("ticker", "date", *values)


def clean_rates(raw: DataFrame) -> DataFrame:
    """Risk-free rate, one row per rolled date."""
    typed = dated(raw).withColumn("risk_free_rate", to_measure("risk_free_rate"))
    order = [F.col(c).desc_nulls_last() for c in ("raw_date", "risk_free_rate")]
    return keep_first(typed, "date", order).select("date", "risk_free_rate")


def parse_news(raw: DataFrame) -> DataFrame:
    """Publication time as timestamp; null where it does not parse."""
    return raw.withColumn("publication_date", parse_feed_time("publication_date"))
