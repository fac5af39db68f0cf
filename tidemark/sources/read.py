"""Readers. Every schema is declared, partition columns included.

A declared ticker stays text, even where all of them look like numbers.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas

PACK = "pack"  # folders that hold several values of a table's first column, which is in the rows then
RANGES = "_ranges"  # beside a clustered table's files: the least and greatest first column of each


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object or one array of objects per line; ``key=value`` folders become columns."""
    return spark.read.schema(schema).json(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.PROFILES)


def read_news(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.NEWS_RAW)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.METRICS_RAW)


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.RATES_RAW)


def read_csv(spark: SparkSession, base: str, glob: str, schema: T.StructType) -> DataFrame:
    """CSV with header below ``base``; folders between ``base`` and the files become columns.

    A header that differs from the schema is an error, not a silent mix-up of columns.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("basePath", base)
        .csv(f"{base.rstrip('/')}/{glob}")
    )


def _read_prices(spark: SparkSession, base: str, below: str, schema: T.StructType) -> DataFrame:
    """Files with the ticker as folder, or packed, with the ticker as last column of the file."""
    if not exists(spark, f"{base}/{PACK}=*"):
        return read_csv(spark, base, f"ticker=*/{below}", schema)
    packed = read_csv(spark, base, f"{PACK}=*/{below}", schema).drop(PACK)
    if not exists(spark, f"{base}/ticker=*"):
        return packed
    return packed.unionByName(read_csv(spark, base, f"ticker=*/{below}", schema))


def has_historical_prices(spark: SparkSession, base: str) -> bool:
    return any(exists(spark, f"{base}/{c}=*/*.csv*") for c in (PACK, "ticker"))


def has_daily_prices(spark: SparkSession, base: str) -> bool:
    return any(exists(spark, f"{base}/{c}=*/{schemas.RUN_DATE[0]}=*") for c in (PACK, "ticker"))


def read_historical_prices(spark: SparkSession, base: str) -> DataFrame:
    """Files directly in a ticker's folder, or a pack's."""
    return _read_prices(spark, base, "*.csv*", schemas.PRICES_RAW)  # compressed ones too


def read_daily_prices(spark: SparkSession, base: str,
                      parts: tuple[str, ...] = schemas.RUN_DATE) -> DataFrame:
    """Files in the run-date folders below a ticker's folder, or a pack's."""
    schema = schemas.with_parts(schemas.PRICES_RAW, parts)
    return _read_prices(spark, base, f"{parts[0]}=*/", schema)


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any folder or file matches, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table."""
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet; give the schema where partition values could be taken for numbers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_folder(spark: SparkSession, path: str, column: str, value: str,
                schema: T.StructType) -> DataFrame:
    """The rows of one value out of a table with a folder per value; no other folder is listed."""
    folder = f"{path}/{column}={value}"
    if not re.fullmatch(r"[A-Za-z0-9.-]+", value):  # others may be written otherwise in a path
        return read_table(spark, path, schema).filter(F.col(column) == F.lit(value))
    if not exists(spark, folder):
        return no_rows(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(folder)


def _file_names(spark: SparkSession, pattern: str) -> set[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return {f.getPath().getName() for f in found or ()}


def is_packed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{PACK}=*")


def is_clustered(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{RANGES}/_SUCCESS")


def read_clustered(spark: SparkSession, path: str, column: str, value: object,
                   schema: T.StructType | None = None) -> DataFrame:
    """The rows of one value out of a table written by ``write.overwrite_clustered``.

    Only the files whose range holds the value are opened, as many as the value has rows for and
    two more at most. Where the kept ranges are not those of the table's files, the whole table is
    read and filtered by its own statistics.
    """
    whole = read_table(spark, path, schema).filter(F.col(column) == F.lit(value))
    if not is_clustered(spark, path):
        return whole
    ranges = spark.read.parquet(f"{path}/{RANGES}")
    known = {r.file: r.holds for r in ranges.select("file", F.lit(value).between(
        F.col("low"), F.col("high")).alias("holds")).collect()}  # a row per file
    if set(known) != _file_names(spark, f"{path}/*.parquet"):
        return whole
    files = sorted(f"{path}/{name}" for name, holds in known.items() if holds)
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).parquet(*files).filter(F.col(column) == F.lit(value))


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A short static table, such as a list of companies."""
    return spark.createDataFrame(list(rows), schema)
