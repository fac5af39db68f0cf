"""Views over the published tables, as readers and the screen use them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.display import METRIC_LABELS, candle, metric_text, sentiment, sentiment_text
from ..functions.safe import first_nonempty, is_blank
from .clean import require_columns
from .joins import broadcast_if_small
from .pick import keep_first

# Published names of the snapshot. Column order is that of the published record.
SNAPSHOT_NAMES = {
    "ticker": "ticker",
    "date": "trading_date",
    "title": "news_title",
    "summary": "news_summary",
    "book_value": "book_value",
    "dividend_yield": "dividend_yield",
    "earnings": "earnings",
    "ev_ebitda": "ev_ebitda",
    "free_float": "free_float",
    "market_cap": "market_cap",
    "payout_ratio": "payout_ratio",
    "recommendation_mean": "recommendation_mean",
    "shares_outstanding": "shares_outstanding",
    "target_mean_price": "target_mean_price",
    "risk_free_rate": "risk_free_rate",
    "1d_return": "1d_return",
    "1w_return": "1w_return",
    "1m_return": "1m_return",
    "3m_return": "3m_return",
    "6m_return": "6m_return",
    "sharpe_ratio_252d": "sharpe_ratio_252d",
    "var_95_252d": "var_95_252d",
    "company_name": "company_name",
    "sector": "sector",
    "industry": "industry",
    "sentiment_score": "sentiment_score",
    "news_date": "news_date",
    "fifty_two_week_high": "high_52w",
    "fifty_two_week_low": "low_52w",
    "PBV": "metric_1",
    "EPS": "metric_2",
    "PER": "optional_metric",
    "12m_return": "ytd_return",
}
# Published names of the chart series.
CHART_NAMES = {
    "date": "trading_date",
    "open": "open_price",
    "high": "high_price",
    "low": "low_price",
    "close": "close_price",
    "volume": "volume",
    "sma_20": "sma_20",
    "sma_50": "sma_50",
    "sma_100": "sma_100",
    "sma_200": "sma_200",
    "ticker": "ticker",
}
# Chart overlays by moving average.
INDICATORS = {
    "sma_20": "indicator_1",
    "sma_50": "indicator_2",
    "sma_100": "indicator_3",
    "sma_200": "indicator_4",
}
# Columns a chart cannot do without.
CHART_REQUIRED = ("open_price", "high_price", "low_price", "close_price", "volume")

NO_VALUE = "—"


def _published(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename and widen: all numbers are served as doubles."""
    require_columns(df, names)
    kinds = dict(df.dtypes)

    def served(source: str, target: str) -> Column:
        c = F.col(f"`{source}`")
        number = kinds[source] not in ("string", "date")
        return (c.cast("double") if number else c).alias(target)

    return df.select(*[served(s, t) for s, t in names.items()])


def serve_snapshot(snapshot: DataFrame) -> DataFrame:
    """The published record; its 12-month return has its own name beside the published one."""
    return _published(snapshot, SNAPSHOT_NAMES).withColumn("return_12m", F.col("ytd_return"))


def serve_chart(chart: DataFrame) -> DataFrame:
    return _published(chart, CHART_NAMES)


def chart_of(spark: SparkSession, chart: DataFrame, ticker: str) -> DataFrame:
    """One ticker's series in date order. The ticker is a parameter, never part of the text."""
    return spark.sql(
        "SELECT * FROM {chart} WHERE ticker = :ticker ORDER BY trading_date",
        args={"ticker": ticker}, chart=serve_chart(chart),
    )


def record_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count"))


def one_row_per_key(snapshot: DataFrame) -> DataFrame:
    """The row with the newest news of each ticker; rows without a ticker are left out."""
    keyed = snapshot.filter(F.col("ticker").isNotNull() & (F.col("ticker") != ""))
    order = [F.col("news_date").desc_nulls_last(), F.col("news_title").asc_nulls_last(),
             F.col("news_summary").asc_nulls_last()]
    return keep_first(keyed, "ticker", order)


def watchlist(wanted: DataFrame, records: DataFrame, key: str = "ticker") -> DataFrame:
    """Every wanted key with its record, if there is one. ``records`` has one row per key.

    A short list thins the records out before they are joined.
    """
    listed = broadcast_if_small(wanted.select(key).distinct())
    found = records.join(listed, on=key, how="left_semi").withColumn("has_record", F.lit(True))
    return wanted.join(found, on=key, how="left").withColumn(
        "has_record", F.coalesce("has_record", F.lit(False)))


def company_labels(snapshot: DataFrame) -> DataFrame:
    none = F.lit(NO_VALUE)
    return snapshot.select(
        "ticker",
        first_nonempty("company_name", "ticker", none).alias("company_label"),
        first_nonempty("sector", none).alias("sector_label"),
        first_nonempty("industry", none).alias("industry_label"),
    )


def chart_indicators(chart: DataFrame) -> DataFrame:
    """Overlay columns next to the moving averages, unless they are there already."""
    present = set(chart.columns)
    return chart.withColumns({
        overlay: F.col(sma) for sma, overlay in INDICATORS.items()
        if sma in present and overlay not in present
    })


def empty_indicators(chart: DataFrame, cols: Sequence[str] = tuple(INDICATORS.values()),
                     key: str = "ticker") -> DataFrame:
    """Per ticker, whether an overlay has no value other than null and zero."""
    return chart.groupBy(key).agg(*[
        F.coalesce(F.bool_and(F.col(c) == 0), F.lit(True)).alias(f"{c}_empty") for c in cols
    ])


def visible_metrics(records: DataFrame, labels: Mapping[str, str] = METRIC_LABELS,
                    key: str = "ticker") -> DataFrame:
    """(ticker, position, metric, label, value) of metrics that are not blank, in label order."""
    shown = [m for m in labels if m in records.columns]
    long = records.select(key, *[F.col(m).cast("double").alias(m) for m in shown]).unpivot(
        key, shown, "metric", "value")
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return long.filter(~is_blank("value")).select(
        key,
        F.array_position(F.lit(list(labels)), F.col("metric")).cast("int").alias("position"),
        "metric", names[F.col("metric")].alias("label"), "value",
    )


def formatted_metrics(records: DataFrame) -> DataFrame:
    return visible_metrics(records).withColumn("text", metric_text("metric", "value"))


def candle_directions(chart: DataFrame) -> DataFrame:
    return require_columns(chart, CHART_REQUIRED).select("ticker", "trading_date",
                        candle("open_price", "close_price").alias("direction"))


def news_headers(records: DataFrame) -> DataFrame:
    """What a news item is headed with; items without a title are not shown."""
    return records.filter(F.coalesce("news_title", F.lit("")) != "").select(
        "ticker", "news_title", "news_date",
        sentiment("sentiment_score").alias("sentiment"),
        sentiment_text("sentiment_score").alias("sentiment_text"),
    )
