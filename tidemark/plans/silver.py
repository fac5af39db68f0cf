"""The wide fact: one row per ticker and trading day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators import series, split
from ..schemas import METRICS

PRICE_COLUMNS = ("close", "high", "low", "open", "volume")
SMA_COLUMNS = tuple(f"sma_{n}" for n in series.SMA_ROWS)
FACT_COLUMNS = (
    "ticker", "date", *PRICE_COLUMNS, *METRICS, "risk_free_rate", *SMA_COLUMNS,
    *series.RETURN_LAGS, "sharpe_ratio_252d", "var_95_252d", "PBV", "EPS", "PER",
)

_KINDS = {"ticker": T.StringType(), "date": T.DateType(), "volume": T.LongType(),
          "earnings": T.LongType(), "market_cap": T.LongType(),
          "shares_outstanding": T.LongType()}
FACT = T.StructType([
    T.StructField(name, _KINDS.get(name, T.DoubleType())) for name in FACT_COLUMNS
])

# Rows a risk measure depends on: the frame itself and the one-day lag of its first row.
LOOK_BACK = series.TRADING_DAYS


def measures(enriched: DataFrame, key="ticker", order: str = "date") -> DataFrame:
    averaged = series.moving_averages(enriched, key=key, order=order)
    returned = series.periodic_returns(averaged, key=key, order=order)
    return series.valuation_ratios(series.risk_measures(returned, key=key, order=order))


def fact_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in FACT_COLUMNS if c in df.columns])


def market_and_risk(prices: DataFrame, metrics: DataFrame, rates: DataFrame,
                    backfill: bool = True) -> DataFrame:
    """Cleaned prices, snapshots and rates to the fact; one shuffle by ticker for all windows."""
    return fact_columns(measures(series.enrich_series(prices, metrics, rates, backfill)))


def market_and_risk_split(prices: DataFrame, metrics: DataFrame, rates: DataFrame,
                          rows: int = split.ROWS, order: str = "date",
                          backfill: bool = True) -> DataFrame:
    """The same fact with no ticker held by one task, for series finer than a day.

    One shuffle by ranges, written, and one by segment, for fills and measures together.
    """
    joined = series.attach_sparse(prices, metrics, rates)
    numbers = split.numbered(joined, "ticker", order)
    segments = split.with_segments(numbers, "ticker", rows, LOOK_BACK)
    filled = split.fill_segments(segments, [c for c in series.FILLED if c in joined.columns],
                                 order=order, backfill=backfill, tasks=split.tasks_for(numbers))
    return fact_columns(split.own_rows(measures(filled, key=split.PIECE, order=order)))
