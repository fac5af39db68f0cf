"""The fact brought up to date with what has landed, without building it anew.

``keep_state`` stores, for each ticker, its newest closes and filled values: as many rows as the
longest frame looks back on, and some to spare. ``update_market_and_risk`` then reads the folders of
the run days since a given day, measures the rows of those days with the stored rows before them,
and replaces the folders of the tickers that have such rows. All other folders keep their files, and
neither the history nor the rest of the fact is read. Of a packed fact the folders that hold such tickers
are replaced, some at a time, with the rows of their other tickers as they are.

Rows land on their own day or later, so all rows of a day and after it lie in the run folders from
that day on. Tickers that the stored rows do not tell enough of (a metric becomes known that earlier
rows are to be filled back with, or more days are replaced than there are rows to spare) are built
anew from their raw files; a replaced day that leaves a ticker without rows builds all anew.

The result is what a build gives. Every step can be run again: folders are staged in the shared
folder and replaced as a whole, the state after them.
"""

from __future__ import annotations

import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import run_date
from ..operators import clean, series
from ..operators.pick import top_per_key
from ..schemas import PRICES_RAW, RUN_DATE
from ..session import configure, stored
from ..sources import read, write
from . import lakehouse, silver
from .lakehouse import Zones

SPARE = 42  # rows beyond the look-back: days that an update may replace without a rebuild
KEPT = silver.LOOK_BACK + SPARE
BATCHES = 8  # in which a packed fact's folders are replaced: old and new ones lie side by side meanwhile
ROLL = 2  # days by which a weekend's snapshot moves on

Feeds = tuple[DataFrame, DataFrame, DataFrame]


def _state_path(zones: Zones) -> str:
    return zones.clean("market_and_risk_state")


def _newest(enriched: DataFrame) -> DataFrame:
    """The rows of each ticker that later ones can look back on; cut before the shuffle."""
    return top_per_key(enriched.select("ticker", "date", "close", *series.FILLED), "ticker",
                       [F.col("date").desc()], KEPT)


def keep_state(spark: SparkSession, zones: Zones) -> None:
    """Store what an update needs to know; call it after the fact was built."""
    configure(spark)
    ends = [h.agg(F.max("date")).first()[0] for h in map(
        clean.clean_prices, lakehouse.raw_history(spark, zones))]
    end = max((e for e in ends if e is not None), default=None)
    enriched = series.enrich_series(*lakehouse.raw_feeds(spark, zones, "ticker"), backfill=False)
    write.overwrite_table(
        _newest(enriched).withColumn("history_end", F.lit(end).cast("date")), _state_path(zones))


def _landed_since(df: DataFrame, day: datetime.date) -> DataFrame:
    """Rows of the run folders from a day on; other folders are not opened."""
    return df.filter(run_date(*RUN_DATE) >= F.lit(day))


def _daily_since(spark: SparkSession, zones: Zones, day: datetime.date) -> DataFrame:
    path = zones.raw("market_data")
    if not read.has_daily_prices(spark, path):
        return clean.clean_prices(read.no_rows(spark, PRICES_RAW))
    return clean.clean_prices(_landed_since(read.read_daily_prices(spark, path), day))


def _feeds_since(spark: SparkSession, zones: Zones, start: datetime.date) -> Feeds:
    """The cleaned feeds' rows from a day on."""
    rolled = start - datetime.timedelta(days=ROLL)
    metrics = _landed_since(read.read_metrics(spark, zones.raw("market_metrics")), rolled)
    rates = _landed_since(read.read_rates(spark, zones.raw("risk_free_rate")), rolled)
    daily = _daily_since(spark, zones, start)
    feeds = (clean.union_prices(daily.limit(0), daily), clean.clean_metrics(metrics),
             clean.clean_rates(rates))
    return tuple(f.filter(F.col("date") >= F.lit(start)) for f in feeds)


def _of(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys, on="ticker", how="left_semi")


def _known(c: str) -> Column:
    return F.col(c).isNotNull()


def _touched(before: DataFrame, fresh: DataFrame, after: DataFrame) -> DataFrame:
    """(ticker, anew): the tickers with rows to write, and whether their stored rows will not do.

    ``before`` and ``after`` are the stored rows before the first replaced day and from it on,
    ``fresh`` the joined rows that replace the latter.
    """
    old = before.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("_old"),
        *[F.max_by(_known(c), "date").alias(f"_was_{c}") for c in series.FILLED])
    gone = after.groupBy("ticker").agg(F.count(F.lit(1)).alias("_gone"))
    new = fresh.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("_new"), *[F.max(_known(c)).alias(f"_is_{c}") for c in series.FILLED])
    both = new.join(gone, on="ticker", how="full").join(old, on="ticker", how="left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("_old", "_gone", "_new")}
    cut_short = (F.col("_old") + F.col("_gone") >= KEPT) & (F.col("_old") < silver.LOOK_BACK)
    filled_back = (F.col("_old") > 0) & reduce(or_, [
        ~F.col(f"_was_{c}") & F.coalesce(f"_is_{c}", F.lit(False)) for c in series.FILLED])
    return both.withColumns(counts).select(
        "ticker", (cut_short | F.coalesce(filled_back, F.lit(False))).alias("anew"),
        (F.col("_old") + F.col("_new") == 0).alias("empty"))


def _continued(before: DataFrame, joined: DataFrame, start: datetime.date) -> tuple[DataFrame, DataFrame]:
    """The fact's rows from a day on, and the same rows filled forwards alone, for the state."""
    both = before.unionByName(joined, allowMissingColumns=True)
    recent = F.col("date") >= F.lit(start)
    forward = series.forward_fill(both, series.FILLED).filter(recent)
    measured = silver.measures(series.fill(both, series.FILLED)).filter(recent)
    return silver.fact_columns(measured), forward


def update_market_and_risk(spark: SparkSession, zones: Zones, since: datetime.date) -> None:
    """Write the rows of ``since`` and after it as the raw files have them now.

    ``since`` is the first day of which anything has landed or was replaced after the last build or
    update; rows that landed late with an earlier date move it back by themselves.
    """
    configure(spark)
    state = spark.read.parquet(_state_path(zones))
    earliest = _daily_since(spark, zones, since).agg(F.min("date")).first()[0]
    start = since if earliest is None else min(since, earliest)
    history_end = state.agg(F.max("history_end")).first()[0]
    if history_end is not None and history_end >= start:
        return _anew(spark, zones)
    prices, metrics, rates = _feeds_since(spark, zones, start)
    joined = stored(series.attach_sparse(prices, metrics, rates), "update-joined")
    old = state.drop("history_end")
    before = old.filter(F.col("date") < F.lit(start))
    touched = stored(_touched(before, joined, old.filter(F.col("date") >= F.lit(start))), "touched")
    if not touched.filter("empty").isEmpty():
        return _anew(spark, zones)
    going_on, anew = (touched.filter(F.col("anew") == b).select("ticker") for b in (False, True))

    newer, forward = _continued(_of(before, going_on), _of(joined, going_on), start)
    packed = lakehouse.fact_is_packed(spark, zones)
    rows, states = newer, _of(before, going_on).unionByName(forward.select(*before.columns))
    if not packed:
        kept = _of(lakehouse.read_fact(spark, zones), going_on).filter(F.col("date") < F.lit(start))
        rows = kept.select(*newer.columns).unionByName(newer)
    if not anew.isEmpty():
        raw = tuple(_of(f, anew) if "ticker" in f.columns else f
                    for f in lakehouse.raw_feeds(spark, zones))
        rows = rows.unionByName(silver.market_and_risk(*raw))
        states = states.unionByName(series.enrich_series(*raw, backfill=False).select(*before.columns))
    folders = stored(rows, "update-rows")
    state_now = stored(
        old.join(touched, on="ticker", how="left_anti").unionByName(_newest(states))
        .withColumn("history_end", F.lit(history_end).cast("date")), "update-state")
    if packed:
        _replace_packed(spark, zones, folders, touched.select("ticker", "anew"), start)
    else:
        write.land(folders, zones.clean("market_and_risk"), "ticker", sort_by=["date"])
    write.overwrite_table(state_now, _state_path(zones))


def _replace_packed(spark: SparkSession, zones: Zones, fresh: DataFrame, touched: DataFrame,
                    start: datetime.date) -> None:
    """Replace the folders that hold touched tickers: of these the rows before ``start`` stay, unless
    the ticker is built anew, and ``fresh`` is added; all rows of others stay.

    Files are read before the new ones take their place, and a folder is read in its own batch alone, so
    every batch can be run again.
    """
    path = zones.clean("market_and_risk")
    packs = sorted(r.pack for r in touched.select(
        write.pack_of("ticker").alias("pack")).distinct().collect())  # 128 at most
    for n in range(BATCHES):
        some = [p for i, p in enumerate(packs) if i % BATCHES == n]
        if not some:
            continue
        old = read.read_table(spark, path, silver.FACT).filter(F.col(read.PACK).isin(some))
        kept = old.join(touched, on="ticker", how="left").filter(
            F.col("anew").isNull() | (~F.col("anew") & (F.col("date") < F.lit(start))))
        added = fresh.withColumn(read.PACK, write.pack_of("ticker")).filter(F.col(read.PACK).isin(some))
        write.land(kept.select(*added.columns).unionByName(added), path, read.PACK,
                   sort_by=["ticker", "date"], compression="zstd")


def _anew(spark: SparkSession, zones: Zones) -> None:
    layout = lakehouse.PACKED if lakehouse.fact_is_packed(spark, zones) else lakehouse.FOLDERS
    lakehouse.build_market_and_risk(spark, zones, layout=layout)
    keep_state(spark, zones)
