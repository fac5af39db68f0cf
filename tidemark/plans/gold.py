"""The published tables: latest snapshot per ticker, and chart series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators import series
from ..operators.pick import latest_per_key, top_per_key
from .silver import FACT_COLUMNS, PRICE_COLUMNS, SMA_COLUMNS

CHART_COLUMNS = ("ticker", "date", *PRICE_COLUMNS, *SMA_COLUMNS)


def latest_market(fact: DataFrame) -> DataFrame:
    """The newest row of each ticker without the chart columns."""
    return latest_per_key(fact.drop(*PRICE_COLUMNS, *SMA_COLUMNS))


def latest_market_from_prices(prices: DataFrame, metrics: DataFrame,
                              rates: DataFrame) -> DataFrame:
    """``latest_market(market_and_risk(...))`` without building the fact.

    Only the newest row is wanted, so its windows become plain aggregates: at most 253 rows per
    ticker leave each map task, and each filled value is the newest one that is known.
    """
    rows = series.TRADING_DAYS
    newest_first = F.col("date").desc()
    recent = top_per_key(prices.select("ticker", "date", "close"), "ticker", [newest_first],
                         rows + 1, rank="_back")
    by_age = Window.partitionBy("ticker").orderBy(newest_first)
    in_frame = F.col("_back") <= rows
    recent = recent.withColumn("_previous", F.lead("close").over(by_age)).withColumn(
        "_return",
        F.when(in_frame, F.try_divide(F.col("close") - F.col("_previous"), F.col("_previous"))),
    )

    def close_at(back: int):
        return F.max(F.when(F.col("_back") == back, F.col("close")))

    risk = recent.groupBy("ticker").agg(
        F.max("date").alias("date"),
        *[F.try_divide(close_at(1) - close_at(1 + n), close_at(1 + n)).alias(name)
          for name, n in series.RETURN_LAGS.items()],
        F.avg("_return").alias("_mean"),
        F.stddev_samp("_return").alias("_stddev"),
        series.tail_value(F.collect_list("_return")).alias("var_95_252d"),
    )
    # The same columns as above, so that both ways share one shuffle of the prices.
    joined = series.attach_sparse(prices.select("ticker", "date", "close"), metrics, rates)
    known = joined.groupBy("ticker").agg(
        F.max_by("close", "date").alias("close"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c)
          for c in series.FILLED if c in joined.columns],
    )
    # One row per ticker on both sides; rows without one are a group as well.
    known = known.withColumnRenamed("ticker", "_ticker")
    latest = risk.join(known, F.col("ticker").eqNullSafe(F.col("_ticker"))).drop(
        "_ticker").withColumn(
        "sharpe_ratio_252d", series.sharpe("_mean", "_stddev", "risk_free_rate"))
    chart_only = {*PRICE_COLUMNS, *SMA_COLUMNS}
    full = series.valuation_ratios(latest)
    return full.select(*[F.col(f"`{c}`") for c in FACT_COLUMNS
                         if c in full.columns and c not in chart_only])


def snapshot(latest: DataFrame, profiles: DataFrame, news: DataFrame) -> DataFrame:
    """Latest row with profile and news: no profile, no row; up to three rows through the news."""
    return latest.join(profiles, on="ticker", how="inner").join(news, on="ticker", how="left")


def chart(fact: DataFrame) -> DataFrame:
    """Chart columns of the fact, or of prices with moving averages: the values are the same."""
    return fact.select(*CHART_COLUMNS)
