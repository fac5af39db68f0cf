"""Declared schemas of all files and tables; nothing is inferred.

Numbers of raw feeds are read as text and cast with ``functions.safe``, so that one bad value
costs one cell and neither the row nor the job.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def with_parts(schema: T.StructType, parts: tuple[str, ...]) -> T.StructType:
    """The schema with whole-number folder columns, such as those of a run date."""
    return T.StructType(schema.fields + [T.StructField(p, T.IntegerType()) for p in parts])


_S, _D, _L, _I, _DATE = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()

DOUBLE_METRICS = (
    "ev_ebitda", "book_value", "dividend_yield", "payout_ratio", "target_mean_price",
    "recommendation_mean", "fifty_two_week_low", "fifty_two_week_high",
)
LONG_METRICS = ("earnings", "market_cap", "shares_outstanding", "free_float")
METRICS = DOUBLE_METRICS + LONG_METRICS

RUN_DATE = ("year", "month", "day")

PROFILES = _struct(ticker=_S, company_name=_S, sector=_S, industry=_S)

# Column order is that of the CSV header.
PRICES_RAW = _struct(Date=_S, Close=_S, High=_S, Low=_S, Open=_S, Volume=_S, ticker=_S)

METRICS_RAW = _struct(**{m: _S for m in METRICS}, ticker=_S, year=_I, month=_I, day=_I)
RATES_RAW = _struct(risk_free_rate=_S, year=_I, month=_I, day=_I)
NEWS_RAW = _struct(
    title=_S, summary=_S, publication_date=_S, ticker=_S, year=_I, month=_I, day=_I
)

PRICES = _struct(ticker=_S, date=_DATE, open=_D, high=_D, low=_D, close=_D, volume=_L)
NEWS = _struct(ticker=_S, title=_S, sentiment_score=_D, summary=_S, news_date=_DATE)

# Reply of a news scorer, as JSON text.
REPLY = T.StructType([
    T.StructField(
        "extracted_news",
        T.ArrayType(_struct(title=_S, sentiment_score=_D, summary=_S)),
    ),
    T.StructField("error", _S),
])
