"""What Spark makes of the operators."""

from __future__ import annotations

import re

import pytest
from helpers import day
from pyspark.sql import functions as F

from tidemark.checks.inputs import feed
from tidemark.checks.queries import QUERIES
from tidemark.operators import clean, joins, news, pick, series, serve
from tidemark.plans import silver
from tidemark.sources import read, write
from tidemark.schemas import PRICES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, operator: str) -> int:
    return len(re.findall(rf"[-+: ]{operator} ", plan(df)))


@pytest.fixture
def px(spark, sf_dir, tmp_path):
    """Prices as a stored table, so that plans show the operators only."""
    path = str(tmp_path / "px")
    feed(spark, sf_dir, "px").write.parquet(path)
    return read.read_table(spark, path, PRICES)


def test_top_k_is_cut_before_the_shuffle(px):
    for df in (pick.latest_per_key(px), pick.keep_first(px, ["ticker", "date"], [F.col("volume")])):
        text = plan(df)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_rank_limit_of_news(spark, sf_dir):
    df = news.newest_news(QUERIES["dedup_exact"](spark, sf_dir).withColumn(
        "publication_date", F.col("publication_date")))
    assert "row_number(), 3, Partial" in plan(df)


def test_measures_share_one_shuffle_and_one_sort(px):
    returned = series.periodic_returns(series.moving_averages(px))
    for df in (returned, series.risk_measures(returned.withColumn("risk_free_rate", F.lit(0.05)))):
        assert count(df, "Exchange") == 1 and count(df, "Sort") == 1


def test_fact_shuffles_prices_by_ticker_once(spark, px, sf_dir):
    metrics = QUERIES["metrics_clean"](spark, sf_dir)
    rates = QUERIES["riskfree_clean"](spark, sf_dir)
    text = plan(silver.market_and_risk(px, metrics, rates))
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", text)) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_deduplicated_feeds_join_without_another_shuffle(spark, px, sf_dir):
    """Two exchanges of the prices in all, with every join by sort-merge."""
    metrics = QUERIES["metrics_clean"](spark, sf_dir)
    rates = QUERIES["riskfree_clean"](spark, sf_dir)
    prices = clean.union_prices(px, px)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(silver.market_and_risk(prices, metrics, rates))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_both = re.findall(r"Exchange hashpartitioning\(ticker#\d+, date#\d+, \d+\)", text)
    by_ticker = re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", text)
    assert (len(by_both), len(by_ticker)) == (2, 1)  # prices and metrics; prices


def test_fact_of_gathered_feeds_moves_no_joined_row(spark, sf_dir):
    """An exchange by ticker of the prices and one of the snapshots, and none between join and windows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES["market_and_risk"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", text)) == 2
    assert not re.findall(r"Exchange hashpartitioning\(ticker#\d+, date#\d+, \d+\)", text)
    assert len(re.findall("SortMergeJoin", text)) == 2  # input, and prices with snapshots


def test_no_frame_runs_from_the_current_row_to_the_end(spark, sf_dir):
    for name in ("fill_both", "bfill", "market_and_risk"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "currentrow$(), unboundedfollowing$()" not in text.lower()


def test_broadcast_only_below_the_limit(spark, px):
    days = px.select("date").distinct()
    small = joins.broadcast_if_small(days)
    large = joins.broadcast_if_small(days, max_rows=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastHashJoin" in plan(px.join(small, "date"))
        assert "SortMergeJoin" in plan(px.join(large, "date"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_chart_of_one_ticker_reads_one_folder(spark, px, tmp_path):
    path = str(tmp_path / "chart")
    table = series.moving_averages(px)
    write.overwrite_partitioned(table, path, "ticker", ["date"])
    df = serve.chart_of(spark, read.read_table(spark, path, table.schema), "7")
    assert re.search(r"PartitionFilters: \[[^\]]*ticker#\d+ = 7", plan(df))
    assert [r["trading_date"] for r in df.collect()] == sorted(
        r["date"] for r in px.filter("ticker = '7'").collect())


def test_a_quote_in_a_ticker_is_just_a_character(spark, px):
    df = serve.chart_of(spark, series.moving_averages(px), "7' or '1' = '1")
    assert df.count() == 0


def test_projection_reaches_the_scan(px):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(
        series.moving_averages(px.select("ticker", "date", "close")))).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ticker", "date", "close"}


def test_aggregates_combine_before_the_shuffle(px):
    text = plan(serve.record_counts(px, ["ticker"]))
    assert "partial_count" in text


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    """A third of all rows is one key's copies of one day."""
    hot = spark.range(30_000).select(F.lit("HOT").alias("ticker"), F.lit(day(0)).alias("date"),
                                     F.col("id").alias("v"))
    rest = spark.range(60_000).select((F.col("id") % 5000).cast("string").alias("ticker"),
                                      F.lit(day(0)).alias("date"), F.col("id").alias("v"))
    df = pick.keep_first(hot.unionByName(rest), ["ticker", "date"], [F.col("v").desc()])
    got = {r["ticker"]: r["v"] for r in df.collect()}
    assert len(got) == 5001 and got["HOT"] == 29_999 and got["0"] == 55_000
    # Each map task sends one row of the key on.
    final = plan(df)
    assert "Partial" in final
