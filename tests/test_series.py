"""Properties of fills, measures and split series, against plain Python."""

from __future__ import annotations

import math
import random

import pytest
from helpers import close_to, column, day, rows
from pyspark.sql import Window, functions as F

from tidemark.operators import series, split
from tidemark.plans import gold, silver

SCHEMA = "ticker string, date date, close double, a double, b double"


@pytest.fixture(scope="module")
def walk(spark):
    """Uneven series; one key holds more rows than all others together."""
    rnd = random.Random(7)
    data = []
    for ticker, days in (("HOT", 900), ("A", 300), ("B", 260), ("C", 40), ("D", 1)):
        price = 100.0
        for i in sorted(rnd.sample(range(days * 2), days)):
            price = max(1.0, price + rnd.randint(-5, 5))
            known = rnd.random() < 0.05
            data.append((ticker, day(i), price, float(rnd.randint(0, 9)) if known else None, None))
    return spark.createDataFrame(data, SCHEMA).repartition(4).cache()


def _by_key(df, *cols):
    out = {}
    for r in rows(df.select("ticker", "date", *cols), "ticker", "date"):
        out.setdefault(r[0], []).append(r[2:])
    return out


def test_fill_is_idempotent_and_whole(walk):
    once = series.fill(walk, ["a", "b"])
    twice = series.fill(once, ["a", "b"])
    assert rows(once) == rows(twice)
    assert once.count() == walk.count()
    nulls = {t: [v[0] for v in vs] for t, vs in _by_key(once, "a").items()}
    assert all(None not in vs or set(vs) == {None} for vs in nulls.values())


def test_backfill_equals_the_literal_frame(walk):
    future = Window.partitionBy("ticker").orderBy("date").rowsBetween(
        Window.currentRow, Window.unboundedFollowing)
    literal = series.forward_fill(walk, ["a"]).withColumn(
        "a", F.coalesce("a", F.first("a", True).over(future)))
    assert rows(series.fill(walk, ["a"])) == rows(literal)


def test_average_of_a_constant(spark):
    df = spark.createDataFrame([("A", day(i), 0.5) for i in range(250)],
                               "ticker string, date date, close double")
    got = series.moving_averages(df).select(*silver.SMA_COLUMNS).distinct().collect()
    assert [tuple(r) for r in got] == [(0.5,) * 4]


def test_measures_equal_plain_python(walk):
    got = _by_key(series.value_at_risk(series.rolling_moments(series.periodic_returns(
        series.moving_averages(walk)))), "close", "sma_20", "sma_200", "1d_return", "12m_return",
        "mean_1d_return", "stddev_1d_return", "var_95_252d")
    for values in got.values():
        closes = [v[0] for v in values]
        returns = [None] + [b / a - 1 for a, b in zip(closes, closes[1:])]
        for i, (_, sma20, sma200, r1, r252, mean, dev, var) in enumerate(values):
            last = lambda n: closes[max(0, i - n + 1):i + 1]
            assert close_to(sma20, sum(last(20)) / len(last(20)))
            assert close_to(sma200, sum(last(200)) / len(last(200)))
            assert close_to(r1, returns[i])
            assert close_to(r252, closes[i] / closes[i - 252] - 1 if i >= 252 else None)
            window = [r for r in returns[max(0, i - 251):i + 1] if r is not None]
            if not window:
                assert mean is dev is var is None
                continue
            m = sum(window) / len(window)
            assert close_to(mean, m, 1e-6)
            if len(window) > 1:
                assert close_to(
                    dev, math.sqrt(sum((r - m) ** 2 for r in window) / (len(window) - 1)), 1e-6)
            rank = max(1, math.ceil(len(window) * 0.05 - 1e-9))
            assert close_to(var, sorted(window)[rank - 1])


@pytest.mark.parametrize("n, tail", [(252, 0.05), (10, 0.5), (128, 0.01), (131, 0.05), (1, 0.05)])
def test_blocks_equal_literal_frames(walk, n, tail):
    """Frames cut into blocks, into one, and of prime length."""
    df = series.periodic_returns(walk, {"1d_return": 1})
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(1 - n, 0)
    literal = df.select(
        "ticker", "date", F.avg("1d_return").over(w).alias("m"),
        F.stddev_samp("1d_return").over(w).alias("s"),
        series.tail_value(F.collect_list("1d_return").over(w), tail).alias("v"))
    blocks = series.value_at_risk(series.rolling_moments(df, rows=n), rows=n, tail=tail, name="v")
    got = rows(blocks.select("ticker", "date", "mean_1d_return", "stddev_1d_return", "v"),
               "ticker", "date")
    for a, b in zip(got, rows(literal, "ticker", "date"), strict=True):
        assert a[:2] == b[:2] and a[4] == b[4]
        assert close_to(a[2], b[2]) and close_to(a[3], b[3])


def test_averages_skip_missing_closes(walk):
    holes = walk.withColumn("close", F.when(F.dayofmonth("date") % 3 != 0, F.col("close")))
    w = Window.partitionBy("ticker").orderBy("date")
    literal = holes.withColumns({
        f"sma_{n}": F.avg("close").over(w.rowsBetween(1 - n, 0)) for n in series.SMA_ROWS})
    assert rows(series.moving_averages(holes).select(literal.columns)) == rows(literal)


@pytest.mark.parametrize("after", ["price * 0 + 64", "price * 0 + pow(2, n)"])
def test_no_deviation_means_no_sharpe_ratio(spark, after):
    """A wild series that goes flat, or that grows by the same factor: exactly zero deviation."""
    df = spark.range(700).select(
        F.lit("A").alias("ticker"), F.date_add(F.lit(day(0)), F.col("id").cast("int")).alias("date"),
        F.lit(0.05).alias("risk_free_rate"), (F.col("id") - 300).alias("n"),
        (F.lit(50.0) + F.col("id") * 7919 % 101 / 3).alias("price"),
    ).withColumn("close", F.when(F.col("n") < 0, F.col("price")).otherwise(F.expr(after)))
    got = column(series.risk_measures(series.periodic_returns(df, {"1d_return": 1})),
                 "sharpe_ratio_252d", "date")
    assert None not in got[2:552] and set(got[553:]) == {None}


@pytest.mark.parametrize("length", [7, 300, 100_000])
def test_split_measures_equal_whole_ones(walk, length):
    def measure(df, key="ticker", order="date"):
        df = series.periodic_returns(series.moving_averages(df, key=key, order=order),
                                     key=key, order=order)
        return series.value_at_risk(df, key=key, order=order)

    got = split.in_segments(walk, measure, look_back=series.TRADING_DAYS, rows=length)
    assert rows(got.select(*walk.columns, "sma_200", "12m_return", "var_95_252d")) == rows(
        measure(walk).select(*walk.columns, "sma_200", "12m_return", "var_95_252d"))


@pytest.mark.parametrize("backfill, length", [(True, 7), (True, 200), (False, 50)])
def test_split_fill_equals_whole_fill(walk, backfill, length):
    got = split.fill_split(walk, ["a", "b"], rows=length, backfill=backfill)
    assert rows(got) == rows(series.fill(walk, ["a", "b"], backfill=backfill))


def test_numbers_follow_key_and_order(walk):
    got = split.numbered(walk).orderBy(split.NUMBER).collect()
    assert [r[split.NUMBER] for r in got] == list(range(len(got)))
    assert [(r.ticker, r.date) for r in got] == sorted((r.ticker, r.date) for r in got)


def test_no_group_holds_more_than_a_segment(walk):
    length, look_back = 100, 252
    segments = split.with_segments(split.numbered(walk), "ticker", length, look_back)
    sizes = segments.groupBy("ticker", split.SEGMENT).count()
    assert sizes.agg(F.max("count")).first()[0] <= length + look_back
    assert segments.filter(split.OWN).count() == walk.count()


def test_one_key_is_dealt_evenly(spark):
    """A key that holds nine tenths of the rows, all of one day: tasks stay even."""
    df = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("T"), F.col("id") % 70)).otherwise("HOT")
        .alias("ticker"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("at"), F.lit(1.0).alias("close"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        measured = split.in_segments(df, lambda d, key, order: series.moving_averages(
            d, [20], key=key, order=order), order="at", look_back=19, rows=200)
        dealt = measured.groupBy(F.spark_partition_id().alias("task")).count().collect()
        sizes = sorted(r["count"] for r in dealt)
        assert len(sizes) == 4 and sum(sizes) == 40_000
        assert sizes[-1] <= 2 * sizes[1]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_split_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, day(0), 1.0), (None, day(1), 3.0), ("A", None, 5.0)],
                               "ticker string, date date, close double")
    got = split.in_segments(df, lambda d, key, order: series.moving_averages(
        d, [2], key=key, order=order), look_back=1, rows=1)
    assert sorted(r["sma_2"] for r in got.collect()) == [1.0, 2.0, 5.0]


def _feeds(spark, walk):
    prices = walk.select("ticker", "date", *[F.col("close").alias(c) for c in
                                             ("open", "high", "low", "close")],
                         F.lit(1).cast("long").alias("volume"))
    metrics = walk.filter(F.col("a").isNotNull()).select(
        "ticker", "date", F.col("a").alias("book_value"), F.col("a").cast("long").alias("earnings"),
        F.lit(4).cast("long").alias("shares_outstanding"), F.lit(2).cast("long").alias("free_float"))
    rates = spark.createDataFrame([(day(i * 7), 0.05 + i / 1000) for i in range(60)],
                                  "date date, risk_free_rate double")
    return prices, metrics, rates


def _rounded(df):
    return rows(df.withColumn("sharpe_ratio_252d", F.round("sharpe_ratio_252d", 6)),
                "ticker", "date")


def test_fact_has_one_row_per_price(spark, walk):
    fact = silver.market_and_risk(*_feeds(spark, walk))
    assert fact.count() == walk.count()
    assert fact.select("ticker", "date").distinct().count() == walk.count()


def test_split_fact_equals_fact(spark, walk):
    feeds = _feeds(spark, walk)
    got = silver.market_and_risk_split(*feeds, rows=120)
    assert _rounded(got) == _rounded(silver.market_and_risk(*feeds))


def test_latest_from_prices_equals_latest_of_fact(spark, walk):
    feeds = _feeds(spark, walk)
    assert _rounded(gold.latest_market_from_prices(*feeds)) == _rounded(
        gold.latest_market(silver.market_and_risk(*feeds)))


@pytest.mark.parametrize("frame", [60, 126, 251, 252])
def test_equal_values_have_no_deviation(spark, frame):
    df = spark.createDataFrame([("T", day(i), 0.1) for i in range(300)],
                               "ticker string, date date, v double")
    got = column(series.rolling_moments(df, "v", frame), "stddev_v", "date")
    assert got[0] is None and set(got[1:]) == {0.0}


def test_tasks_of_a_split_fill_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(split, "TASK_ROWS", 1_000)
    walk = spark.range(20_000).select(
        F.lit("A").alias("ticker"), F.col("id").alias("date"),
        F.when(F.col("id") % 7 == 3, F.col("id")).alias("a"))
    for n in (10_000, 20_000):
        filled = split.fill_split(walk.limit(n), ["a"], rows=100)
        held = filled.groupBy(F.spark_partition_id()).count().collect()
        assert len(held) > 0.8 * n / 1_000 and max(r["count"] for r in held) <= 4_000
        assert filled.filter(F.col("a") != F.greatest(
            F.lit(3), F.col("date") - (F.col("date") + 4) % 7)).count() == 0


def test_as_of_rows_carry_their_day_and_side_once(spark, monkeypatch):
    moved = []
    whole = split.fill_split

    def fill_split(df, *args, **kwargs):
        moved.append(df.columns)
        return whole(df, *args, **kwargs)

    monkeypatch.setattr(split, "fill_split", fill_split)
    prices = spark.createDataFrame([("A", day(n), 1.0 * n) for n in (1, 3, 4)], "ticker string, date date, close double")
    known = spark.createDataFrame([("A", day(2), 5), ("A", day(4), None)], "ticker string, date date, earnings long")
    got = series.attach_asof(prices, known, split_rows=2)
    assert moved == [["ticker", "_at", "_known", "_row"]]
    assert rows(got, "date") == [("A", day(1), 1.0, None), ("A", day(3), 3.0, 5), ("A", day(4), 4.0, None)]
