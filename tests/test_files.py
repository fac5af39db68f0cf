"""Files in and out: declared types, landing again, and the whole run over folders."""

from __future__ import annotations

import json
import os

import pytest
from helpers import close_to, column, day, rows
from pyspark.sql import functions as F, types as T

from tidemark import schemas, session
from tidemark.operators import serve
from tidemark.operators.statements import EARNINGS_LINE
from tidemark.plans import gold, ingest, lakehouse, silver
from tidemark.sources import read, write
from tidemark.streaming import landing

HEADER = "Date,Close,High,Low,Open,Volume"


def put(root, path, text):
    full = os.path.join(str(root), path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w") as f:
        f.write(text)


@pytest.fixture
def zones(tmp_path):
    """Two numeric-looking tickers and one without a profile."""
    b = tmp_path / "bronze"
    put(b, "company_profiles/profiles.json", json.dumps([
        {"ticker": "0700", "company_name": "Seven", "sector": "Tech", "industry": "Games"},
        {"ticker": "0005", "company_name": "Five", "sector": "Banks", "industry": "Regional"}]))
    for t in ("0700", "0005", "NOPE"):
        lines = [f"{day(i)},{100 + i},{101 + i}.5,{99 + i},{100 + i},{1000 + i}.0" for i in range(6)]
        put(b, f"market_data/ticker={t}/historical_data.csv", "\n".join([HEADER, *lines]) + "\n")
        put(b, f"market_data/ticker={t}/year=2026/month=01/day=06/data.csv",
            f"{HEADER}\n{day(5)},200,201,199,200,3000000000\n")
    # 2026-01-03 is a Saturday and rolls onto Monday, the 5th, a trading day.
    put(b, "market_metrics/ticker=0700/year=2026/month=01/day=03/metrics.json", json.dumps(
        {"book_value": 50.0, "earnings": 1e9, "shares_outstanding": 10, "free_float": 4,
         "ev_ebitda": float("nan"), "market_cap": None}))
    put(b, "risk_free_rate/year=2026/month=01/day=02/risk_free_rate.json",
        json.dumps({"risk_free_rate": 0.0671}))
    put(b, "news_data/ticker=0700/year=2026/month=01/day=02/news.json", json.dumps(
        [{"title": f"t{i}", "summary": "s", "publication_date":
          f"Thu, {i + 1:02d} Jan 2026 07:00:00 GMT"} for i in range(5)]
        + [{"title": "undated", "summary": "s", "publication_date": None}]))
    return lakehouse.Zones(str(b), str(tmp_path / "silver"), str(tmp_path / "gold"))


def test_raw_to_gold(spark, zones):
    for _ in range(2):  # a second run replaces the first
        lakehouse.build_silver(spark, zones)
        lakehouse.build_gold(spark, zones)
    snapshot = read.read_table(spark, zones.published("snapshot"))
    got = {(r["ticker"], r["title"]): r for r in snapshot.collect()}
    assert sorted(got, key=str) == [("0005", None), ("0700", "t2"), ("0700", "t3"), ("0700", "t4")]
    r = got["0700", "t4"]
    assert (r["sector"], r["date"], r["sentiment_score"]) == ("tech", day(5), 0.0)
    assert (r["PBV"], r["EPS"], r["free_float"]) == (200 / 50, 1e8, 0.4)
    assert r["ev_ebitda"] is None and r["market_cap"] is None
    assert close_to(r["1d_return"], (200 - 104) / 104)
    assert r["risk_free_rate"] == 0.0671
    assert "close" not in snapshot.columns and "sma_20" not in snapshot.columns

    chart = read.read_table(spark, zones.published("chart_data"), T.StructType(
        [silver.FACT[c] for c in gold.CHART_COLUMNS]))
    assert chart.count() == 18
    seven = serve.chart_of(spark, chart, "0700").collect()
    assert [s["trading_date"] for s in seven] == [day(i) for i in range(6)]
    assert seven[-1]["volume"] == 3e9 and seven[-1]["close_price"] == 200.0

    fact = lakehouse.read_fact(spark, zones).filter("ticker = '0700'")
    assert column(fact, "book_value", "date") == [50.0] * 6  # before the first snapshot as well
    served = serve.one_row_per_key(serve.serve_snapshot(snapshot))
    assert column(served, "news_title", "ticker") == [None, "t4"]


def test_published_tables_answer_sql(spark, zones):
    lakehouse.build_silver(spark, zones)
    lakehouse.build_market_and_risk(spark, zones, split_rows=4)
    lakehouse.build_gold(spark, zones)
    lakehouse.register_views(spark, zones)
    assert spark.sql("SELECT * FROM snapshot").count() == 4
    one = spark.sql("SELECT * FROM chart_data WHERE ticker = '0700' ORDER BY date")
    assert "PartitionFilters: [isnotnull(ticker" in one._jdf.queryExecution().toString()
    assert column(one, "date") == [day(i) for i in range(6)]
    served = spark.sql("SELECT ticker, ytd_return, metric_1 FROM served_snapshot")
    assert ("0700", None, 4.0) in [tuple(r) for r in served.collect()]
    assert spark.sql("SELECT close_price FROM served_chart_data").count() == 18


def test_both_layouts_publish_the_same(spark, zones):
    def published():
        lakehouse.register_views(spark, zones)
        return [rows(t) for t in (
            spark.table("chart_data").select(*gold.CHART_COLUMNS), spark.table("snapshot"),
            lakehouse.read_fact(spark, zones).select(*silver.FACT_COLUMNS),
            lakehouse.chart_of(spark, zones, "0700"))]

    lakehouse.build_silver(spark, zones)
    lakehouse.build_gold(spark, zones)
    folders = published()
    lakehouse.build_silver(spark, zones, layout=lakehouse.CLUSTERED)
    lakehouse.build_gold(spark, zones, lakehouse.CLUSTERED)
    assert not read.exists(spark, f"{zones.published('chart_data')}/ticker=*")
    assert published() == folders
    lakehouse.build_chart(spark, zones)  # and back
    assert not read.is_clustered(spark, zones.published("chart_data"))
    assert published() == folders
    with pytest.raises(ValueError):
        lakehouse.build_chart(spark, zones, "heap")


def test_clustered_table_opens_the_files_of_a_value(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "HOT").otherwise((F.col("id") % 1000).cast("string"))
        .alias("ticker"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        write.overwrite_clustered(df, path, ["ticker", "id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    every = read.read_table(spark, path, df.schema)
    assert len(every.inputFiles()) == 24
    for ticker, most in (("7", 2), ("999", 2), ("HOT", 14)):
        one = read.read_clustered(spark, path, "ticker", ticker, df.schema)
        assert 1 <= len(one.inputFiles()) <= most
        assert rows(one) == rows(every.filter(F.col("ticker") == ticker))
    assert read.read_clustered(spark, path, "ticker", "ZZZ", df.schema).count() == 0
    # A file that the ranges do not know of is read all the same.
    spark.createDataFrame([("7", -1, "new")], df.schema).write.mode("append").parquet(path)
    late = read.read_clustered(spark, path, "ticker", "7", df.schema)
    assert late.filter("id = -1").count() == 1


def test_news_once_per_key(spark, zones):
    item = {"ticker": "0700", "title": "t9", "publication_date": "Thu, 29 Jan 2026 07:00:00 GMT"}
    lines = [json.dumps(item | {"summary": s}) for s in ("b", "a")]
    spark.createDataFrame([(s,) for s in lines], "value string").write.mode("append").text(
        zones.raw("news_data") + "/ticker=0700/year=2026/month=01/day=30")

    def titles(**how):
        lakehouse.build_news(spark, zones, **how)
        news = read.read_table(spark, zones.clean("news_data")).filter("title = 't9'")
        return sorted(r.summary for r in news.collect())

    assert titles() == ["a", "b"]
    assert titles(news_keys=["ticker", "title", "publication_date"]) == ["a"]


def test_wrong_header_is_an_error(spark, tmp_path):
    put(tmp_path, "ticker=A/x.csv", "Date,Open,High,Low,Close,Volume\n2026-01-01,1,2,3,4,5\n")
    with pytest.raises(Exception, match="header"):
        read.read_historical_prices(spark, str(tmp_path)).collect()


def test_partition_values_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("0700", day(0), 1.0), ("1E2", day(0), 2.0)],
                               "ticker string, date date, close double")
    path = str(tmp_path / "t")
    write.overwrite_partitioned(df, path)
    assert rows(read.read_table(spark, path, df.schema).select(*df.columns)) == rows(df)


def test_landing_replaces_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "ticker string, year int, v int"

    def land(*data):
        write.land(spark.createDataFrame(data, schema), path, ["ticker", "year"])

    land(("A", 2025, 1), ("A", 2026, 2), ("B", 2026, 3))
    land(("A", 2026, 9))
    write.land(spark.createDataFrame([], schema), path, ["ticker", "year"])
    back = read.read_table(spark, path).select("ticker", "year", "v")
    assert rows(back) == [("A", 2025, 1), ("A", 2026, 9), ("B", 2026, 3)]


def test_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    """Rebalancing may cut one folder's rows into several files."""
    path = str(tmp_path / "t")
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise((F.col("id") % 50).cast("string"))
        .alias("ticker"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write.overwrite_partitioned(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(f"{path}/ticker=HOT") if f.endswith(".parquet")]
    assert len(files) > 1
    assert read.read_table(spark, path).count() == 200_000


def test_arrivals_are_landed_once_and_added(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("inbox", "out", "state"))
    schema = schemas.METRICS_RAW

    def arrive(name, **values):
        put(inbox, name, json.dumps(values))

    def run():
        stream = landing.follow_files(spark, inbox, schema)
        query = landing.land_arrivals(stream, out, state, ["ticker", *schemas.RUN_DATE])
        assert query.awaitTermination(120)

    def landed():
        return rows(read.read_metrics(spark, out).select("ticker", "day", "book_value"))

    arrive("1.json", ticker="0700", year=2026, month=1, day=5, book_value=1.0)
    arrive("2.json", ticker="0005", year=2026, month=1, day=5, book_value=2.0)
    run()
    assert landed() == [("0005", 5, "2.0"), ("0700", 5, "1.0")]
    arrive("3.json", ticker="0700", year=2026, month=1, day=5, book_value=9.0)
    run()
    run()
    assert landed() == [("0005", 5, "2.0"), ("0700", 5, "1.0"), ("0700", 5, "9.0")]


def test_landed_rows_do_not_depend_on_batches(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    for i in range(3):
        put(inbox, f"{i}.json", json.dumps(
            {"ticker": "0700", "year": 2026, "month": 1, "day": 5, "book_value": float(i)}))
    for files in (1, 10):
        out, state = str(tmp_path / f"out{files}"), str(tmp_path / f"state{files}")
        stream = landing.follow_files(spark, inbox, schemas.METRICS_RAW, maxFilesPerTrigger=files)
        assert landing.land_arrivals(
            stream, out, state, ["ticker", *schemas.RUN_DATE]).awaitTermination(120)
        assert column(read.read_metrics(spark, out), "book_value", "book_value") == [
            "0.0", "1.0", "2.0"]


def _zones(tmp_path):
    return lakehouse.Zones(*(str(tmp_path / z) for z in ("bronze", "silver", "gold")))


def _quotes(spark, start, days, ticker="0700"):
    return spark.createDataFrame(
        [(ticker, day(i), 1.0, 1.0, 1.0, 1.0, 5) for i in range(start, start + days)], PRICE)


def test_history_again_keeps_daily_prices(spark, tmp_path):
    zones = _zones(tmp_path)
    ingest.land_history(_quotes(spark, 0, 5), zones)
    assert lakehouse.raw_prices(spark, zones).count() == 5  # before any daily landing
    for run in (5, 6, 7):
        ingest.land_daily_prices(_quotes(spark, run, 1), _quotes(spark, 0, 9, "INDEX"), zones, day(run))
    ingest.land_history(_quotes(spark, 0, 5), zones)
    assert lakehouse.raw_prices(spark, zones).count() == 8


def test_daily_news_keep_the_first_pull(spark, tmp_path):
    zones = _zones(tmp_path)
    companies = spark.createDataFrame([("0700", "Seven Seas")], "ticker string, company_name string")
    texts = spark.createDataFrame(
        [(1, "seven seas a", "x", f"{day(-3)} 09:00:00"), (2, "seven seas b", "y", f"{day(-2)} 09:00:00"),
         (3, "seven seas c", "z", f"{day(0)} 09:00:00")],
        "id long, title string, summary string, ts string").withColumn(
        "publication_date", F.to_timestamp("ts")).drop("ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")  # landing keeps to UTC
        ingest.land_news(texts, companies, zones, day(0), first=True)
        ingest.land_news(texts, companies, zones, day(0))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    landed = read.read_news(spark, zones.raw("news_data"))
    assert column(landed, "title", "title") == ["seven seas a", "seven seas b", "seven seas c"]
    assert column(landed, "publication_date", "title")[0].endswith("09:00:00 GMT")


def test_work_dir_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert a.startswith(base) and a != b


PRICE = "ticker string, date date, open double, high double, low double, close double, volume long"


def test_pulled_tables_to_gold(spark, tmp_path):
    zones = lakehouse.Zones(*(str(tmp_path / z) for z in ("bronze", "silver", "gold")))
    companies = spark.createDataFrame(
        [("0700.HK", "Seven Seas", "Tech", "Games"), ("0005.HK", "Five", "Banks", "Regional")],
        "ticker string, company_name string, sector string, industry string")

    def quotes(start, days, close, tickers=("0700.HK", "0005.HK")):
        return spark.createDataFrame(
            [(t, day(i), close, close, close, close, 5) for t in tickers
             for i in range(start, start + days)], PRICE)

    benchmark = quotes(0, 12, 1.0, ("INDEX",))
    ingest.land_profiles(companies, zones)
    ingest.land_history(quotes(0, 10, 100.0), zones)
    for run in (10, 11, 12, 10):  # the 12th day has no benchmark, the 10th is run twice
        ingest.land_daily_prices(quotes(run, 1, 100.0 + run), benchmark, zones, day(run))
    info = spark.createDataFrame(
        [("0700.HK", "bookValue", 55.5), ("0700.HK", "netIncomeToCommon", 0.0),
         ("0700.HK", "sharesOutstanding", 10.0), ("0700.HK", "other", 1.0)],
        "ticker string, name string, value double")
    lines = spark.createDataFrame(
        [("0700.HK", EARNINGS_LINE, day(0), 40.0), ("0700.HK", EARNINGS_LINE, day(-90), 1.0)],
        "ticker string, label string, period date, value double")
    ingest.land_metrics(info, lines, zones, day(4))
    pages = spark.createDataFrame(
        [('<h2 id="description">now 6.71%</h2>',), ("<p>8.00%</p>",)], "html string")
    ingest.land_rate(pages, zones, day(4))
    texts = spark.createDataFrame(
        [(1, "SEVEN seas up", "x", f"{day(10)} 09:00:00"), (2, "code 0700 seen", "y", f"{day(10)} 08:00:00"),
         (3, "seven, seas", "old", f"{day(9)} 09:00:00"), (4, "nothing", "z", f"{day(10)} 09:00:00")],
        "id long, title string, summary string, ts string").withColumn(
        "publication_date", F.to_timestamp("ts")).drop("ts")
    ingest.land_news(texts, companies, zones, day(10), suffix=".HK")

    lakehouse.build_silver(spark, zones)
    lakehouse.build_gold(spark, zones)
    fact = lakehouse.read_fact(spark, zones).filter("ticker = '0700.HK'")
    assert column(fact, "close", "date") == [100.0] * 10 + [110.0, 111.0]
    got = read.read_table(spark, zones.published("snapshot")).filter("ticker = '0700.HK'")
    assert rows(got.select("title", "PBV", "EPS", "risk_free_rate", "date"), "title") == [
        ("SEVEN seas up", 111 / 55.5, 4.0, 6.71 / 100, day(11)),
        ("code 0700 seen", 111 / 55.5, 4.0, 6.71 / 100, day(11))]
