"""Key/value statement lines to columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.safe import first_nonzero
from .pick import Keys, as_list

# Metric of each key of a company's info record.
INFO_METRICS = {
    "enterpriseToEbitda": "ev_ebitda",
    "bookValue": "book_value",
    "netIncomeToCommon": "earnings",
    "dividendYield": "dividend_yield",
    "payoutRatio": "payout_ratio",
    "targetMeanPrice": "target_mean_price",
    "recommendationMean": "recommendation_mean",
    "marketCap": "market_cap",
    "sharesOutstanding": "shares_outstanding",
    "floatShares": "free_float",
    "fiftyTwoWeekLow": "fifty_two_week_low",
    "fiftyTwoWeekHigh": "fifty_two_week_high",
}
# Fixed value: statement line used where the info record has no earnings.
EARNINGS_LINE = "Net Income Common Stockholders"


def latest_statement_value(lines: DataFrame, keys: Keys = ("ticker", "label"),
                           period: str = "period", value: str = "value") -> DataFrame:
    """Value of the newest period per line; null if that period has none."""
    return lines.groupBy(*as_list(keys)).agg(F.max_by(value, period).alias(value))


def pivot_metrics(info: DataFrame, names: Mapping[str, str] = INFO_METRICS,
                  key: Keys = "ticker", name: str = "name", value: str = "value") -> DataFrame:
    """One column per known name. One hash aggregate; unknown names are ignored."""
    return info.groupBy(*as_list(key)).agg(*[
        F.max(F.when(F.col(name) == source, F.col(value))).alias(metric)
        for source, metric in names.items()
    ])


def earnings_or_statement(metrics: DataFrame, lines: DataFrame, label: str = EARNINGS_LINE,
                          key: str = "ticker") -> DataFrame:
    """Earnings that are null or zero give way to the newest statement value."""
    newest = latest_statement_value(lines.filter(F.col("label") == label), key)
    return (
        metrics.join(newest.withColumnRenamed("value", "_statement"), on=key, how="left")
        .withColumn("earnings", first_nonzero("earnings", "_statement"))
        .drop("_statement")
    )
