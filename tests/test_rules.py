"""Hand-computed rows for the rules where engines or Spark versions differ."""

from __future__ import annotations

import datetime
import html
import random

import pytest
from helpers import close_to, column, day, rows
from pyspark.sql import functions as F

from tidemark.functions import dates, display, safe, text
from tidemark.operators import clean, joins, pick, serve, series, statements

D = datetime.date


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}")


def evaluate(spark, c, value=None, kind="string"):
    return one(spark, value, kind).select(c.alias("x")).first()["x"]


# -- casts ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("raw, whole", [
    ("12", 12), ("12.0", 12), ("3000000000", 3_000_000_000), ("-2.7", -2), ("n/a", None),
    ("", None), (None, None), ("1e3", 1000)])
def test_to_long(spark, raw, whole):
    assert evaluate(spark, safe.to_long("v"), raw) == whole


def test_bad_cells_become_null(spark):
    assert evaluate(spark, safe.to_double("v"), "abc") is None
    assert evaluate(spark, safe.to_date("v"), "2026-13-01") is None
    assert evaluate(spark, safe.to_measure("v"), "NaN") is None
    assert evaluate(spark, safe.to_measure("v"), "1.5") == 1.5


@pytest.mark.parametrize("a, b, q", [(1.0, 4.0, .25), (1.0, 0.0, None), (1.0, None, None),
                                     (None, 2.0, None)])
def test_ratio(spark, a, b, q):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(safe.ratio("a", "b")).first()[0] == q


@pytest.mark.parametrize("a, b, x", [(5, 7, 5), (0, 7, 7), (None, 7, 7), (0, None, None)])
def test_first_nonzero(spark, a, b, x):
    df = spark.createDataFrame([(a, b)], "a long, b long")
    assert df.select(safe.first_nonzero("a", "b")).first()[0] == x


@pytest.mark.parametrize("raw, blank", [(None, True), ("0", True), ("0.0", True), ("3", False),
                                        ("abc", False), ("", False)])
def test_is_blank(spark, raw, blank):
    assert evaluate(spark, safe.is_blank("v"), raw) is blank


# -- dates ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("raw, rolled", [
    (D(2026, 5, 2), D(2026, 5, 4)), (D(2026, 5, 3), D(2026, 5, 4)),
    (D(2026, 5, 4), D(2026, 5, 4)), (D(2026, 5, 8), D(2026, 5, 8)), (None, None)])
def test_weekend_roll(spark, raw, rolled):
    assert evaluate(spark, dates.weekend_roll("v"), raw, "date") == rolled


@pytest.mark.parametrize("parts, made", [
    ((2026, 4, 9), D(2026, 4, 9)), ((2026, 2, 30), None), ((2026, None, 4), None)])
def test_run_date(spark, parts, made):
    df = spark.createDataFrame([parts], "y int, m int, d int")
    assert df.select(dates.run_date("y", "m", "d")).first()[0] == made


@pytest.mark.parametrize("raw, epoch", [
    ("Wed, 29 Apr 2026 07:00:00 GMT", 1777446000), ("Fri, 1 May 2026 00:00:01 GMT", 1777593601),
    ("yesterday", None), (None, None)])
def test_feed_time(spark, raw, epoch):
    assert evaluate(spark, F.unix_timestamp(dates.parse_feed_time("v")), raw) == epoch


def test_run_window_is_half_open(spark):
    df = spark.createDataFrame(
        [("2026-04-28 23:59:59",), ("2026-04-29 00:00:00",), ("2026-04-30 00:00:00",)],
        "s string").withColumn("ts", F.to_timestamp("s"))
    kept = df.filter(dates.in_run_window("ts", F.lit(D(2026, 4, 29)), 0, 1))
    assert column(kept, "s") == ["2026-04-29 00:00:00"]


# -- texts ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("raw, rate", [
    ("The yield rose to 6.71% from 6.5%", 0.0671), ("7% flat", None), (None, None)])
def test_percent(spark, raw, rate):
    got = evaluate(spark, text.percent("v"), raw)
    assert close_to(got, rate)


@pytest.mark.parametrize("html, found", [
    ('<h2 id="description">The <b>rate</b> is 6.71% &amp; up</h2>', "The rate is 6.71% & up"),
    ('<H2 class="x" id=description>a\nb</H2><h2 id="description">c</h2>', "a\nb"),
    ('<h2 id="other">a</h2>', None), ('<h2 data-id="description">a</h2>', None),
    ('<h2 id="description"></h2>', ""), (None, None)])
def test_element_text(spark, html, found):
    assert evaluate(spark, text.element_text("v", "h2", "description"), html) == found


def test_words(spark):
    assert evaluate(spark, text.words("v"), "PT Bank-Utama  Raya, (Tbk)!") == [
        "pt", "bank", "utama", "raya", "tbk"]
    assert evaluate(spark, text.words("v"), " .. ") == []


# -- display --------------------------------------------------------------------------------------

@pytest.mark.parametrize("metric, value, shown", [
    ("market_cap", 1.5e12, "$1.50T"), ("market_cap", 2_345_000_000.0, "$2.35B"),
    ("market_cap", 7e6, "$7.00M"), ("market_cap", 12345.4, "$12,345"),
    ("market_cap", -3e9, "$-3.00B"), ("high_52w", 1234.5, "$1,234.50"),
    ("ytd_return", 0.126, "0.13%"), ("ytd_return", 1234.5, "1234.50%"),
    ("metric_1", 9.87654, "9.8765"), ("metric_1", 12345.678, "12,345.68"),
    ("metric_1", 0.125, "0.1250"), ("high_52w", 0.125, "$0.12")])
def test_metric_text(spark, metric, value, shown):
    df = spark.createDataFrame([(metric, value)], "m string, v double")
    assert df.select(display.metric_text("m", "v")).first()[0] == shown


def python_text(metric, v):
    if metric == "ytd_return":
        return f"{v:.2f}%"
    if metric == "market_cap":
        for unit, letter in ((1e12, "T"), (1e9, "B"), (1e6, "M")):
            if abs(v) >= unit:
                return f"${v / unit:.2f}{letter}"
        return f"${v:,.0f}"
    if metric == "high_52w":
        return f"${v:,.2f}"
    return f"{v:,.4f}" if abs(v) < 10 else f"{v:,.2f}"


def test_metric_text_equals_python_formats(spark):
    rnd = random.Random(3)
    values = [0.125, 0.375, 2.675, 1.005, 0.5, 1.5, 2.5, 999_999.5, 1e6, 1e9, 1e12, 9.99995, 10.0]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-3, 14) for _ in range(400)]
    values += [rnd.randint(-10 ** 6, 10 ** 6) / 8 for _ in range(200)]
    pairs = [(m, v) for v in values for m in ("ytd_return", "market_cap", "high_52w", "metric_1")]
    df = spark.createDataFrame(pairs, "m string, v double").withColumn(
        "t", display.metric_text("m", "v"))
    wrong = [tuple(r) for r in df.collect() if r["t"] != python_text(r["m"], r["v"])]
    assert wrong == []


@pytest.mark.parametrize("score, label", [
    (0.5, "Bullish (+0.500)"), (-0.25, "Bearish (-0.250)"), (0.0, "Neutral (+0.000)"),
    (None, None)])
def test_sentiment(spark, score, label):
    assert evaluate(spark, display.sentiment_text("v"), score, "double") == label


# -- cleaning -------------------------------------------------------------------------------------

PRICE = "ticker string, date date, open double, high double, low double, close double, volume long"


def test_daily_feed_wins_over_historical(spark):
    old = spark.createDataFrame([("A", day(0), 1., 1., 1., 1., 10), ("A", day(1), 1., 1., 1., 1., 10)],
                                PRICE)
    new = spark.createDataFrame([("A", day(1), 2., 2., 2., 2., 3_000_000_000)], PRICE)
    merged = clean.union_prices(old, new)
    assert rows(merged.select("date", "close", "volume")) == [
        (day(0), 1., 10), (day(1), 2., 3_000_000_000)]


def test_union_allows_a_missing_column(spark):
    old = spark.createDataFrame([("A", day(0), 1., 1., 1., 1., 10)], PRICE)
    new = spark.createDataFrame([("A", day(1), 1., 1., 1., 1.)], PRICE.rsplit(",", 1)[0])
    assert column(clean.union_prices(old, new), "volume", "date") == [10, None]


def test_weekend_and_monday_snapshots_collide(spark):
    raw = spark.createDataFrame(
        [("A", 2026, 5, 2, "1"), ("A", 2026, 5, 3, "2"), ("A", 2026, 5, 4, "3"),
         ("B", 2026, 5, 2, "4")],
        "ticker string, year int, month int, day int, book_value string")
    assert rows(clean.clean_metrics(raw)) == [
        ("A", D(2026, 5, 4), 3.0), ("B", D(2026, 5, 4), 4.0)]


def test_rates_keep_the_latest_raw_date(spark):
    raw = spark.createDataFrame([(2026, 5, 2, "0.05"), (2026, 5, 3, "0.06")],
                                "year int, month int, day int, risk_free_rate string")
    assert rows(clean.clean_rates(raw)) == [(D(2026, 5, 4), 0.06)]


def test_whole_row_dedup_keeps_other_folders(spark):
    df = spark.createDataFrame([("A", "t", 1), ("A", "t", 1), ("A", "t", 2)],
                               "ticker string, title string, day int")
    assert pick.distinct_rows(df).count() == 2


def test_require_columns(spark):
    with pytest.raises(ValueError, match="close_price, volume"):
        clean.require_columns(one(spark, "x"), ["v", "volume", "close_price"])


# -- joins and fills ------------------------------------------------------------------------------

def test_snapshot_off_a_trading_day_is_lost(spark):
    px = spark.createDataFrame([("A", day(0)), ("A", day(2))], "ticker string, date date")
    metrics = spark.createDataFrame([("A", day(1), 5.0), ("A", day(2), 7.0)],
                                    "ticker string, date date, book_value double")
    assert rows(joins.join_snapshots(px, metrics)) == [("A", day(0), None), ("A", day(2), 7.0)]


def _sparse(spark):
    return spark.createDataFrame(
        [("A", day(0), None, None), ("A", day(1), 1.0, None), ("A", day(2), None, None),
         ("A", day(3), 3.0, None), ("A", day(4), None, None), ("B", day(0), 9.0, None)],
        "ticker string, date date, a double, b double")


def test_fills(spark):
    df = _sparse(spark)
    assert column(series.fill(df, ["a", "b"], backfill=False), "a", "ticker", "date") == [
        None, 1, 1, 3, 3, 9]
    assert column(series.fill(df, ["a", "b"]), "a", "ticker", "date") == [1, 1, 1, 3, 3, 9]
    assert column(series.backward_fill(df, ["a"]), "a", "ticker", "date") == [
        1, 1, None, 3, None, 9]
    assert column(series.fill(df, ["a", "b"]), "b", "ticker", "date") == [None] * 6


def test_first_day_closed_market(spark):
    px = spark.createDataFrame([("A", day(0)), ("A", day(1))], "ticker string, date date")
    index = spark.createDataFrame([("I", day(1)), ("I", day(1))], "ticker string, date date")
    assert rows(joins.trading_days_only(px, index)) == [(day(1), "A")]


# -- measures -------------------------------------------------------------------------------------

def _prices(spark, closes, ticker="A"):
    return spark.createDataFrame(
        [(ticker, day(i), c) for i, c in enumerate(closes)],
        "ticker string, date date, close double")


def test_partial_averages_and_returns(spark):
    df = series.periodic_returns(series.moving_averages(_prices(spark, [2., 4., 0., 6.]), [2]),
                                 {"1d_return": 1, "1w_return": 5})
    assert column(df, "sma_2", "date") == [2, 3, 2, 3]
    assert column(df, "1d_return", "date") == [None, 1.0, -1.0, None]  # nothing against zero
    assert column(df, "1w_return", "date") == [None] * 4


def test_risk_of_short_and_flat_series(spark):
    df = _prices(spark, [1., 1., 1., 1.]).withColumn("risk_free_rate", F.lit(0.05))
    got = series.risk_measures(series.periodic_returns(df, {"1d_return": 1}))
    assert column(got, "sharpe_ratio_252d", "date") == [None] * 4
    assert column(got, "var_95_252d", "date") == [None, 0, 0, 0]


def test_sharpe_by_hand(spark):
    df = _prices(spark, [100., 110., 99.]).withColumn("risk_free_rate", F.lit(0.0252))
    got = series.risk_measures(series.periodic_returns(df, {"1d_return": 1}))
    # Returns 0.1 and -0.1: mean 0, deviation sqrt(0.02), daily rate 0.0001.
    expected = (0 - 0.0001) / 0.02 ** 0.5 * 252 ** 0.5
    assert close_to(column(got, "sharpe_ratio_252d", "date")[2], expected, 1e-6)
    assert close_to(column(got, "var_95_252d", "date")[2], -0.1)


def test_ratios(spark):
    df = spark.createDataFrame(
        [(10., 4., 100, 50, 25), (10., 0., -100, 0, 25), (10., None, None, 50, None)],
        "close double, book_value double, earnings long, shares_outstanding long, free_float long")
    got = series.valuation_ratios(df).select("PBV", "EPS", "PER", "free_float").collect()
    assert [tuple(r) for r in got] == [
        (2.5, 2.0, 5.0, 0.5), (None, None, None, None), (None, None, None, None)]


# -- statements -----------------------------------------------------------------------------------

def test_newest_statement_value_may_be_null(spark):
    lines = spark.createDataFrame(
        [("A", "x", day(0), 1), ("A", "x", day(1), None), ("A", "y", day(0), 2)],
        "ticker string, label string, period date, value long")
    assert rows(statements.latest_statement_value(lines)) == [("A", "x", None), ("A", "y", 2)]


def test_earnings_fall_back_on_zero_and_null(spark):
    lines = spark.createDataFrame(
        [(t, statements.EARNINGS_LINE, day(0), 9) for t in "ABC"],
        "ticker string, label string, period date, value long")
    metrics = spark.createDataFrame([("A", 0), ("B", None), ("C", 5), ("D", 0)],
                                    "ticker string, earnings long")
    assert rows(statements.earnings_or_statement(metrics, lines)) == [
        ("A", 9), ("B", 9), ("C", 5), ("D", None)]


# -- serving --------------------------------------------------------------------------------------

def test_one_row_per_key_takes_the_newest_news(spark):
    df = spark.createDataFrame(
        [("A", day(0), "z", ""), ("A", day(1), "b", ""), ("A", day(1), "a", ""),
         ("B", None, None, None), ("", day(1), "q", ""), (None, day(1), "q", "")],
        "ticker string, news_date date, news_title string, news_summary string")
    assert column(serve.one_row_per_key(df), "news_title", "ticker") == ["a", None]


def test_watchlist_marks_missing_records(spark):
    wanted = spark.createDataFrame([("A",), ("X",)], "ticker string")
    records = spark.createDataFrame([("A", 1), ("B", 2)], "ticker string, v int")
    assert rows(serve.watchlist(wanted, records)) == [("A", 1, True), ("X", None, False)]


def test_labels(spark):
    df = spark.createDataFrame([("A", "", "s", None), ("B", "b", None, "")],
                               "ticker string, company_name string, sector string, industry string")
    assert rows(serve.company_labels(df)) == [("A", "A", "s", "—"), ("B", "b", "—", "—")]


def test_visible_metrics_skip_blanks_and_keep_order(spark):
    df = spark.createDataFrame([("A", 0.0, 2.0, None, 1.0)],
                               "ticker string, ytd_return double, high_52w double, "
                               "metric_1 double, market_cap double")
    assert rows(serve.visible_metrics(df), "position") == [
        ("A", 1, "market_cap", "Market Cap", 1.0), ("A", 3, "high_52w", "52-Week High", 2.0)]


def test_empty_indicators(spark):
    df = spark.createDataFrame([("A", 0.0, None, 1.0), ("A", None, None, 0.0)],
                               "ticker string, x double, y double, z double")
    assert rows(serve.empty_indicators(df, ["x", "y", "z"])) == [("A", True, True, False)]


def test_chart_keeps_existing_indicators(spark):
    df = spark.createDataFrame([(1.0, 2.0, 9.0)], "sma_20 double, sma_50 double, indicator_1 double")
    got = serve.chart_indicators(df).first()
    assert (got["indicator_1"], got["indicator_2"]) == (9.0, 2.0)


def test_what_is_no_number_is_neutral_and_down(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1.0), (1.0, nan)], "a double, b double")
    got = df.select(display.sentiment("a"), display.candle("b", "a")).collect()
    assert [tuple(r) for r in got] == [("Neutral", "down"), ("Bullish", "down")]


REFERENCES = ["a &amp;lt; b", "&#8217;&#x27;&eacute;&ndash;", "&copy 2020 &copyx &notit; &notin; x",
              "&#0;&#xD800;&#99999999;&#x110000;", "&#128;&#x92;&#159", "&& & &; &x; &#; &#x;",
              "&#0000065;&#x00041", "plain", "", "&fjlig;"]


@pytest.mark.parametrize("page", REFERENCES)
def test_decode_references_like_the_standard_library(spark, page):
    assert evaluate(spark, text.decode_references("v"), page) == html.unescape(page)


@pytest.mark.parametrize("hidden", [
    '<!-- <h2 id="description">1.00%</h2> -->',
    "<script>'<h2 id=description>2.00%</h2>'</script>",
    "<STYLE x><h2 id=description>3.00%</h2></style >",
])
def test_hidden_elements_do_not_count(spark, hidden):
    page = f'<html>{hidden}<h2 id="description">6.71&percnt;</h2></html>'
    assert evaluate(spark, text.element_text("v", "h2", "description"), page) == "6.71%"
    unclosed = '<html><!-- <h2 id="description">1.00%</h2>'
    assert evaluate(spark, text.element_text("v", "h2", "description"), unclosed) is None


def test_small_is_counted_in_rows_and_bytes(spark):
    df = spark.createDataFrame([("é" * 10, 1), (None, 2)], "v string, n int")
    assert joins.is_small(df, 2, 20)
    assert not joins.is_small(df, 1, 20)
    assert not joins.is_small(df, 2, 19)
    assert joins.is_small(df.limit(0), 0, 0)
