"""Rows picked per key: deduplication, latest row, top k.

All of these are ``row_number`` plus a filter with nothing between, which Spark turns into a
group limit that runs before the shuffle too. A key with any share of the rows sends at most k
rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row deduplication; copies collapse before the shuffle."""
    return df.dropDuplicates()


def top_per_key(df: DataFrame, keys: Keys, order: Sequence[Column], k: int,
                rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each key. ``order`` must not leave ties."""
    name = rank or "_rank"
    ranked = df.withColumn(
        name, F.row_number().over(Window.partitionBy(*as_list(keys)).orderBy(*order))
    ).filter(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def keep_first(df: DataFrame, keys: Keys, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return top_per_key(df, keys, order, 1)


def latest_per_key(df: DataFrame, keys: Keys = "ticker", date: str = "date") -> DataFrame:
    return keep_first(df, keys, [F.col(date).desc()])
