"""Token totals by source, language and tokenizer version, kept up by signed changes.

A batch of changes is summed to one row per total it touches, and only those rows are stored, in a
folder of the batch's own. Committing a batch again replaces that folder by the same rows, so a
batch counts once however often it is retried. Totals are the sums over all batches: they need no
look at documents that have not changed, and batches may come in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

KEYS = ("source", "lang", "tokenizer")
_SCHEMA = T.StructType([*[T.StructField(k, T.StringType()) for k in KEYS],
                        T.StructField("docs", T.LongType()), T.StructField("tokens", T.LongType()),
                        T.StructField("batch", T.StringType())])


def word_count(text: Column) -> Column:
    """Words parted by ASCII blanks; null has none."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.coalesce(F.size(words), F.lit(0)).cast("bigint")


def byte_count(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def counted(docs: DataFrame, counters: dict[str, Column], keep: tuple[str, ...] = (),
            id_col: str = "doc_id") -> DataFrame:
    """(id, source, lang, tokenizer, tokens): one row per row and tokenizer version."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("tokenizer"), c.cast("bigint").alias("tokens"))
                               for name, c in counters.items()])).alias("_c")
    return docs.select(id_col, "source", "lang", *keep, each).select(
        id_col, "source", "lang", *keep, "_c.tokenizer", "_c.tokens")


def inserts(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return _change(rows, F.lit(1), F.col(tokens))


def deletes(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return _change(rows, F.lit(-1), -F.col(tokens))


def revisions(rows: DataFrame, old: str, new: str = "tokens") -> DataFrame:
    """A count that was ``old`` is ``new``; the document is the same one."""
    zero = F.lit(0)
    return _change(rows, zero, F.coalesce(F.col(new), zero) - F.coalesce(F.col(old), zero))


def _change(rows: DataFrame, docs: Column, tokens: Column) -> DataFrame:
    return rows.select(*KEYS, docs.cast("bigint").alias("docs"),
                       F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens"))


def commit(changes: DataFrame, path: str, batch: str) -> None:
    """Store the sums of a batch; the same batch again changes nothing."""
    (changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
     .write.mode("overwrite").parquet(f"{path}/batch={batch}"))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """(source, lang, tokenizer, docs, tokens); totals without documents and tokens go.

    Null keys are totals of their own.
    """
    rows = spark.read.schema(_SCHEMA).parquet(path)
    return (rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .filter("docs <> 0 OR tokens <> 0"))
