"""Exact duplicates by content-defined chunk recipes.

Every text is cut where its own content says so. Chunks are deduplicated by their whole content,
which verifies that a 128-bit chunk identifier stands for one content only; a text is then the
ordered list of its identifiers, and equal lists are equal texts. Chunk contents move once (each
task sends one copy of each), whole texts never; lists are a few bytes per text.

Built-in functions only. Nothing is gathered: groups are counted with partial aggregation, and the
join that brings a group's result back is one Spark may split where a group is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import lower_ascii, stored

# A chunk ends at a line end or sentence end, at the earliest after the first and at the latest
# after the second number of characters.
MIN_CHUNK, MAX_CHUNK = 1024, 8192


def chunks_of(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The chunks of a text, in order; together they are the text."""
    cut = rf"(?s).{{{least},{most - 1}}}?(?:\n|(?<=[.!?]) )|.{{{most}}}|.+"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def chunk_ids(chunk: Column) -> list[Column]:
    """Two independent 64-bit hashes."""
    return [F.xxhash64(chunk), F.xxhash64(F.lit(1), chunk)]


def _recipe(text: Column, ids=chunk_ids) -> Column:
    return F.flatten(F.transform(chunks_of(text), lambda c: F.array(*ids(c))))


def _ambiguous(texts: DataFrame, ids) -> DataFrame:
    """Identifiers that stand for more than one chunk content."""
    contents = texts.select(F.explode(chunks_of(F.col("_norm"))).alias("_chunk")).distinct()
    return (contents.select(F.array(*ids(F.col("_chunk"))).alias("_id"))
            .groupBy("_id").count().filter("count > 1").select("_id"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                     ids=chunk_ids) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after lower-casing A-Z; null counts as empty, and empty texts
    are equal to one another. The row with the largest id stays; a null id is smaller than all.
    Of rows that give the same largest id twice exactly one has kept = true.
    Very long texts are lists of more chunks. An empty table gives an empty result.
    """
    norm = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    texts = docs.select(F.col(id_col).alias("_doc"), norm.alias("_norm"))
    rows = texts.select("_doc", _recipe(F.col("_norm"), ids).alias("_recipe"),
                        F.sha2("_norm", 256).alias("text_sha256"))
    ambiguous = stored(_ambiguous(texts, ids), "ambiguous-chunks")
    if ambiguous.isEmpty():
        rows = rows.withColumn("_whole", F.lit(None).cast("string"))
    else:
        rows = _told_apart(texts, ambiguous, ids)
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "chunk-recipes")
    key = ["_recipe", "_whole"]
    last = F.max(F.struct("_doc", "_row"))
    groups = rows.groupBy(*key).agg(last.alias("_last"), F.count("*").alias("group_size"))
    groups = groups.select(*[F.col(k).alias(f"g{k}") for k in key], "_last", "group_size")
    same = (F.col("_recipe") == F.col("g_recipe")) & F.col("_whole").eqNullSafe(F.col("g_whole"))
    return rows.join(groups, same).select(
        F.col("_doc").alias(id_col),
        F.col("_last._doc").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_last._row")).alias("kept"),
        "text_sha256",
    )


def _told_apart(texts: DataFrame, ambiguous: DataFrame, ids) -> DataFrame:
    """Lists with an identifier of two contents carry their whole text as well."""
    rows = texts.select("_doc", "_norm", _recipe(F.col("_norm"), ids).alias("_recipe"))
    width = len(ids(F.lit("")))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("_recipe") / width).cast("int") - 1),
                        lambda i: F.slice("_recipe", i * width + 1, width))
    hit = (rows.filter(F.size("_recipe") > 0).select("_recipe", F.explode(pairs).alias("_id"))
           .join(ambiguous, "_id", "left_semi")
           .select(F.col("_recipe").alias("_hit")).distinct())
    marked = rows.join(hit, F.col("_recipe") == F.col("_hit"), "left")
    return marked.select("_doc", "_recipe", F.sha2("_norm", 256).alias("text_sha256"),
                         F.when(F.col("_hit").isNotNull(), F.col("_norm")).alias("_whole"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows that share id and text one stays."""
    kept = duplicate_groups(docs, id_col, text).filter("kept").select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"))
    sha = F.sha2(lower_ascii(F.coalesce(F.col(text), F.lit(""))), 256)
    keyed = docs.withColumn("__sha", sha).withColumn("__id", F.col(id_col))
    each = Window.partitionBy("__id", "__sha").orderBy("__id")
    ided = keyed.join(kept, ["__id", "__sha"], "left_semi")
    blank = keyed.filter("__id IS NULL").join(
        kept.filter("__id IS NULL").select("__sha"), "__sha", "left_semi").select(ided.columns)
    first = F.row_number().over(each).alias("__n")
    return (ided.select("*", first).unionByName(blank.select("*", first))
            .filter("__n = 1").select(*docs.columns))
