"""The corpus pipeline: documents in, packed sequences out.

Toxic documents go, then exact copies, then near copies, then passages that stand in an earlier
document; what is left is packed. Each stage takes the documents its predecessor kept, and all but
the last return the columns of ``documents``. Every stage is written and read again, so a lost
executor costs tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import exact_dedup, packing, queries, simhash, substring
from tidemark.llm import toxicity as lexicon
from tidemark.session import work_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(spark, docs, sf_dir)
    scored = lexicon.score(docs, model, name="__toxicity")
    return scored.filter(F.col("__toxicity") < 0.5).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, width=3, radius=2)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("substring_dedup", passages),
    ("packing", packed),
]

# Learned scores and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
