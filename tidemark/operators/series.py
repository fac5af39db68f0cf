"""Fills and rolling measures over keyed series.

A series has one row per key and date (``clean`` sees to that), so one key's window never holds
more rows than the calendar has days, some 36,500 in a century, however much data there is. All
measures of a key share one shuffle and one sort. For series ordered by something finer than a
day, ``split`` has the same operators over bounded pieces of a key.

Frames count rows, not days, and start with however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.safe import ratio
from ..schemas import METRICS
from . import split
from .joins import join_global, join_snapshots
from .pick import Keys, as_list

# Rows looked back for each moving average and each return, and the risk window.
SMA_ROWS = (20, 50, 100, 200)
RETURN_LAGS = {
    "1d_return": 1,
    "1w_return": 5,
    "1m_return": 21,
    "3m_return": 63,
    "6m_return": 126,
    "12m_return": 252,
}
TRADING_DAYS = 252
VAR_TAIL = 0.05

FILLED = (*METRICS, "risk_free_rate")


def _series(key: Keys, order: str) -> WindowSpec:
    return Window.partitionBy(*as_list(key)).orderBy(order)


def _last_rows(key: Keys, order: str, n: int) -> WindowSpec:
    return _series(key, order).rowsBetween(1 - n, Window.currentRow)


def last_known(c: str, key: Keys = "ticker", order: str = "date") -> Column:
    past = _series(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(c, ignorenulls=True).over(past)


def first_known(c: str, key: Keys = "ticker", order: str = "date") -> Column:
    """First value of the whole key.

    Where no earlier value exists this is also the next later one, so it fills backwards without
    a frame from the current row to the end, which costs quadratic time.
    """
    whole = _series(key, order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return F.first(c, ignorenulls=True).over(whole)


def forward_fill(df: DataFrame, cols: Sequence[str], key: Keys = "ticker",
                 order: str = "date") -> DataFrame:
    return df.withColumns({c: last_known(c, key, order) for c in cols})


def backward_fill(df: DataFrame, cols: Sequence[str], key: Keys = "ticker",
                  order: str = "date") -> DataFrame:
    """Rows before the first value get it; later gaps stay."""
    return df.withColumns({
        c: F.when(last_known(c, key, order).isNull(), first_known(c, key, order)).otherwise(
            F.col(c))
        for c in cols
    })


def fill(df: DataFrame, cols: Sequence[str], key: Keys = "ticker", order: str = "date",
         backfill: bool = True) -> DataFrame:
    """Forward fill, then the rows before the first value get that value."""
    if not backfill:
        return forward_fill(df, cols, key, order)
    return df.withColumns({
        c: F.coalesce(last_known(c, key, order), first_known(c, key, order)) for c in cols
    })


def attach_sparse(prices: DataFrame, metrics: DataFrame, rates: DataFrame) -> DataFrame:
    """Prices with the snapshots of their own dates, not filled yet."""
    return join_global(join_snapshots(prices, metrics), rates)


def enrich_series(prices: DataFrame, metrics: DataFrame, rates: DataFrame,
                  backfill: bool = True) -> DataFrame:
    """Every trading day with the most recent weekly values."""
    joined = attach_sparse(prices, metrics, rates)
    return fill(joined, [c for c in FILLED if c in joined.columns], backfill=backfill)


def attach_asof(prices: DataFrame, snapshots: DataFrame, key: Keys = "ticker", order: str = "date",
                split_rows: int | None = None) -> DataFrame:
    """Every row with the columns of the last snapshot of its key on its own day or before.

    No join by range: snapshots are put among the rows, before those of their own day, and the last
    one is carried forward as a whole, nulls in it included. With ``split_rows`` no task holds more
    of a key than so many rows.
    """
    keys = as_list(key)
    values = [c for c in snapshots.columns if c not in (*keys, order)]
    own = [c for c in prices.columns if c not in (*keys, order)]
    # The side and the day are moved once, within ``_at``.
    known = snapshots.select(*keys, F.struct(order, F.lit(0).alias("_side")).alias("_at"),
                             F.struct(*values).alias("_known"))
    both = known.unionByName(
        prices.select(*keys, F.struct(order, F.lit(1).alias("_side")).alias("_at"),
                      F.struct(*own).alias("_row")), allowMissingColumns=True)
    filled = (forward_fill(both, ["_known"], key, "_at") if split_rows is None
              else split.fill_split(both, ["_known"], key=key, order="_at", rows=split_rows,
                                    backfill=False))
    return filled.filter(F.col("_at._side") == 1).select(
        *keys, F.col("_at")[order].alias(order), "_row.*", "_known.*")


def attach_asof_global(prices: DataFrame, values: DataFrame, order: str = "date") -> DataFrame:
    """The same for a series that holds for all keys: as of each day that has rows, then by day."""
    days = prices.select(order).distinct().withColumn("_day", F.lit(0))
    # A row per day of the calendar on either side, so one window may hold all of them.
    return join_global(prices, attach_asof(days, values.withColumn("_all", F.lit(0)), [], order).drop(
        "_day", "_all"), order)


def enrich_asof(prices: DataFrame, metrics: DataFrame, rates: DataFrame,
                split_rows: int | None = None) -> DataFrame:
    """``enrich_series`` as of each day: a snapshot off the trading days counts from the next one on,
    and none is carried backwards."""
    return attach_asof_global(attach_asof(prices, metrics, split_rows=split_rows), rates)


def _bases(rows: Sequence[int]) -> dict[int, int]:
    """For each frame length the longest shorter one it is a multiple of, or itself."""
    bases: dict[int, int] = {}
    for n in sorted(rows):
        own = [b for b in bases if bases[b] == b]
        bases[n] = max((b for b in own if n % b == 0), default=n)
    return bases


def moving_averages(df: DataFrame, rows: Sequence[int] = SMA_ROWS, value: str = "close",
                    key: Keys = "ticker", order: str = "date") -> DataFrame:
    """Averages over the last rows.

    A frame costs a row its length, so a long frame is put together from earlier rows' shorter
    ones: 200 rows are the sums of four times 50. Sums are only added, never subtracted.
    """
    w = _series(key, order)
    bases = _bases(rows)
    sums = {}
    for base in sorted(set(bases.values())):
        frame = _last_rows(key, order, base)
        sums |= {f"_sum_{base}": F.sum(value).over(frame),
                 f"_count_{base}": F.count(value).over(frame)}

    def total(part: str, n: int) -> Column:
        base = bases[n]
        name = f"_{part}_{base}"
        earlier = [F.coalesce(F.lag(name, i * base).over(w), F.lit(0))
                   for i in range(1, n // base)]
        return reduce(add, earlier, F.coalesce(name, F.lit(0)))

    return df.withColumns(sums).withColumns({
        f"sma_{n}": F.try_divide(total("sum", n), total("count", n)) for n in rows
    }).drop(*sums)


def periodic_returns(df: DataFrame, lags: Mapping[str, int] = RETURN_LAGS, value: str = "close",
                     key: Keys = "ticker", order: str = "date") -> DataFrame:
    """Relative change against earlier rows; null before they exist and against zero.

    Lags are columns of their own first: written twice in a formula, each would be computed twice.
    """
    w = _series(key, order)
    lagged = df.withColumns({f"_{name}": F.lag(value, n).over(w) for name, n in lags.items()})
    return lagged.withColumns({
        name: F.try_divide(F.col(value) - F.col(f"_{name}"), F.col(f"_{name}")) for name in lags
    }).drop(*[f"_{name}" for name in lags])


def _block_steps(rows: int, longest: int = 8, most: int = 8) -> tuple[int, list[int]]:
    """The length of the shortest blocks of a frame, and how many are put together in each step.

    A row's cost is the length of the shortest, which it aggregates, and the blocks looked up. A
    frame that cannot be cut so is aggregated whole, or in the shortest blocks that there are.
    """
    length, steps = rows, []
    while length > longest and (n := next((n for n in range(2, most + 1) if length % n == 0), 1)) > 1:
        length, steps = length // n, [n, *steps]
    return length, steps


def _merged_moments(df: DataFrame, blocks: Sequence[int]) -> DataFrame:
    """Count, mean and squared deviations of all blocks, into those of the newest.

    Merging by the difference of the means loses no digits. Block means of equal values may
    differ in the last bit, so equal values are known by their least and largest.
    """
    for i in blocks:
        n, m, s = (F.col(c) for c in ("_n", "_m", "_s"))
        n_i, m_i, s_i = (F.col(f"{c}{i}") for c in ("_n", "_m", "_s"))
        share = F.coalesce(F.try_divide(n_i, n + n_i), F.lit(0.0))
        df = df.withColumns({
            "_n": n + n_i,
            "_m": m + (m_i - m) * share,
            "_s": s + s_i + (m_i - m) * (m_i - m) * n * share,
        })
    return df


def _block_measures(df: DataFrame, value: str, rows: int, key: Keys, order: str,
                    mean: str | None = None, stddev: str | None = None,
                    var: str | None = None, tail: float = VAR_TAIL) -> DataFrame:
    """Mean and sample deviation, and lower quantile, over the last rows.

    The frame is cut into equal blocks, and these again. Each row aggregates the shortest block that
    ends with it, a fraction of the frame, and merges it, step by step, with the blocks that end at
    fixed rows before it. Of a block's values only as many of the least are handed on as the
    quantile's rank can reach.
    """
    length, steps = _block_steps(rows)
    frame, w = _last_rows(key, order, length), _series(key, order)
    own = {"_n": F.count(value).over(frame)}
    if mean:
        own |= {"_m": F.avg(value).over(frame), "_s": F.var_pop(value).over(frame),
                "_lo": F.min(value).over(frame), "_hi": F.max(value).over(frame)}
    if var:
        own["_least"] = F.collect_list(value).over(frame)
    df = df.withColumns(own)
    kept: dict[str, Column] = {"_n": F.col("_n").cast("double")}
    none: dict[str, Column] = {"_n": F.lit(0.0)}
    if mean:
        kept |= {"_m": F.coalesce("_m", F.lit(0.0)),
                 "_s": F.coalesce(F.col("_s") * F.col("_n"), F.lit(0.0)),
                 "_lo": F.col("_lo"), "_hi": F.col("_hi")}
        absent = F.lit(None).cast("double")
        none |= {"_m": F.lit(0.0), "_s": F.lit(0.0), "_lo": absent, "_hi": absent}
    if var:
        most = max(1, math.ceil(rows * Decimal(str(tail))))
        kept["_least"] = F.slice(F.sort_array("_least"), 1, most)
        none["_least"] = F.array().cast("array<double>")
    df = df.withColumns(kept)
    for count in steps:
        before = range(1, count)
        earlier = {f"{c}{i}": F.coalesce(F.lag(c, i * length).over(w), none[c])
                   for c in kept for i in before}
        df = df.withColumns(earlier)
        if var:
            least = F.sort_array(F.concat("_least", *[f"_least{i}" for i in before]))
            df = df.withColumn("_least", F.slice(least, 1, most))
        if mean:
            df = df.withColumns({"_lo": F.least("_lo", *[f"_lo{i}" for i in before]),
                                 "_hi": F.greatest("_hi", *[f"_hi{i}" for i in before])})
            df = _merged_moments(df, before)
        else:
            df = df.withColumn("_n", reduce(add, [F.col(f"_n{i}") for i in before], F.col("_n")))
        df, length = df.drop(*earlier), length * count
    if var:
        df = df.withColumn(var, F.try_element_at("_least", _tail_rank(F.col("_n").cast("int"), tail)))
    if mean:
        spread = F.when(F.col("_lo") == F.col("_hi"), 0.0).otherwise(
            F.sqrt(F.col("_s") / (F.col("_n") - 1)))
        df = df.withColumns({
            mean: F.when(F.col("_n") > 0, F.col("_m")),
            stddev: F.when(F.col("_n") > 1, spread),
        })
    return df.drop(*kept)


def rolling_moments(df: DataFrame, value: str = "1d_return", rows: int = TRADING_DAYS,
                    key: Keys = "ticker", order: str = "date") -> DataFrame:
    return _block_measures(df, value, rows, key, order, f"mean_{value}", f"stddev_{value}")


def sharpe(mean: Column | str, stddev: Column | str, rate: Column | str,
           rows: int = TRADING_DAYS) -> Column:
    """Annualised excess return per unit of deviation; null unless the deviation is positive."""
    m, s, r = (F.col(c) if isinstance(c, str) else c for c in (mean, stddev, rate))
    daily_rate = F.coalesce(r, F.lit(0.0)) / F.lit(float(rows))
    return F.when(s > 0, (m - daily_rate) / s * F.lit(math.sqrt(rows)))


def _tail_rank(count: Column, tail: float) -> Column:
    """Nearest rank. As a decimal the product is exact: a whole number stays one under ceil."""
    return F.greatest(F.ceil(count * F.lit(Decimal(str(tail)))).cast("int"), F.lit(1))


def tail_value(values: Column, tail: float = VAR_TAIL) -> Column:
    """Nearest-rank lower quantile of an array, null for an empty one.

    ``sort_array`` sorts primitives; ``array_sort`` calls a comparator and took 2.5 times as long.
    """
    return F.try_element_at(F.sort_array(values), _tail_rank(F.size(values), tail))


def value_at_risk(df: DataFrame, value: str = "1d_return", rows: int = TRADING_DAYS,
                  tail: float = VAR_TAIL, key: Keys = "ticker", order: str = "date",
                  name: str = "var_95_252d") -> DataFrame:
    """Historical value at risk, sign kept: a loss is negative."""
    return _block_measures(df, value, rows, key, order, var=name, tail=tail)


def risk_measures(df: DataFrame, key: Keys = "ticker", order: str = "date") -> DataFrame:
    """Sharpe ratio and value at risk of the daily returns, in one pass over their blocks."""
    measured = _block_measures(df, "1d_return", TRADING_DAYS, key, order, "_mean", "_stddev",
                               "var_95_252d")
    return measured.withColumn(
        "sharpe_ratio_252d", sharpe("_mean", "_stddev", "risk_free_rate")
    ).drop("_mean", "_stddev")


def valuation_ratios(df: DataFrame) -> DataFrame:
    """Price to book, earnings per share, price to earnings; free float becomes a ratio."""
    eps = ratio("earnings", "shares_outstanding")
    return df.withColumns({
        "PBV": ratio("close", "book_value"),
        "EPS": eps,
        "PER": ratio("close", eps),
        "free_float": ratio("free_float", "shares_outstanding"),
    })
