"""Texts that mention an entity by name or by code.

A phrase is looked for only in texts that hold its anchor, the word of it that is used least. Uses
are counted over all texts for the words of the phrases, so names that share a long or frequent word
do not bring every text together with every one of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import NOT_WORD, spaced_words, strip_suffix, word_array
from ..session import stored
from .joins import MAX_BROADCAST_ROWS, is_small

# A word with more uses than this, and with more than one in so many of all counted uses, is salted:
# there are at most so many such words.
HEAVY_USES = 100_000
HEAVY_WORDS = 10_000


def search_terms(entities: DataFrame, key: str = "ticker", name: str = "company_name",
                 suffix: str = "") -> DataFrame:
    """(key, phrase): an entity is searched by its name and by its code without suffix."""
    code = strip_suffix(key, suffix) if suffix else F.col(key)
    return (
        entities.select(key, F.explode(F.array(F.col(name), code)).alias("_text"))
        .select(key, spaced_words("_text").alias("phrase"))
        .filter(F.col("phrase") != "")
        .distinct()
    )


def _padded(c: Column) -> Column:
    """A blank on both sides, so that only whole words are found inside."""
    return F.concat(F.lit(" "), c, F.lit(" "))


def _distinct_words(spaced: Column | str) -> Column:
    return F.explode(F.array_distinct(word_array(spaced)))


def word_counts(texts: DataFrame, terms: DataFrame, text: str, small: bool) -> DataFrame:
    """(anchor, uses): how often each word of the phrases is used; unused words are absent."""
    wanted = terms.select(_distinct_words("phrase").alias("anchor")).distinct()
    said = texts.select(F.explode(F.split(F.lower(text), NOT_WORD)).alias("anchor"))
    # Words of a short list are few enough to filter by in the scan. Counts combine before they
    # are shuffled.
    found = (said.join(F.broadcast(wanted), on="anchor", how="left_semi").groupBy("anchor") if small
             else said.groupBy("anchor"))
    counts = found.agg(F.count(F.lit(1)).alias("uses"))
    return counts if small else counts.join(wanted, on="anchor", how="left_semi")


def anchored(terms: DataFrame, counts: DataFrame, key: str = "ticker") -> DataFrame:
    """(key, phrase, anchor): the word of each phrase that is used least.

    A phrase with a word that is not used at all is in no text and drops out.
    """
    words = terms.select(key, "phrase", _distinct_words("phrase").alias("anchor"))
    counted = words.join(counts, on="anchor", how="left")
    best = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "anchor")).alias("_best")
    return counted.groupBy(key, "phrase").agg(best).filter(F.col("_best.uses") > 0).select(
        key, "phrase", F.col("_best.anchor"))


def _salted(hits: DataFrame, terms: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: hits of a heavy word are dealt out, and its terms stand in each part."""
    total = counts.agg(F.sum("uses")).first()[0] or 0
    limit = max(HEAVY_USES, total // HEAVY_WORDS)
    # No more than total / limit words can be above the limit.
    heavy = counts.filter(F.col("uses") > limit).select(
        "anchor", F.ceil(F.col("uses") / F.lit(limit)).cast("int").alias("_salts"))
    parts = F.coalesce("_salts", F.lit(1))
    dealt = hits.join(F.broadcast(heavy), on="anchor", how="left").withColumn(
        "_salt", F.pmod("_row", parts).cast("int")).drop("_salts")
    copied = terms.join(F.broadcast(heavy), on="anchor", how="left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_salts")
    return dealt, copied


def candidates(texts: DataFrame, terms: DataFrame, text_id: str = "doc_id", text: str = "text",
               key: str = "ticker", keep: Sequence[str] = (),
               max_terms: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Pairs of a term and a text that has its anchor: what is searched for the whole phrase."""
    row = F.struct(text_id, text, *keep)
    spoken = texts.select(text_id, *keep, _padded(spaced_words(text)).alias("_text"),
                          F.xxhash64(row).alias("_row"), F.xxhash64(F.lit(1), row).alias("_row2"))
    small = is_small(terms, max_terms)
    counts = stored(word_counts(texts, terms, text, small), "word-counts")
    chosen = anchored(terms, counts, key)
    word = _distinct_words("_text").alias("anchor")
    if small:  # an anchor each, so not more rows than there are terms
        return spoken.select("*", word).join(F.broadcast(chosen), on="anchor")
    hits, chosen = _salted(spoken.select("_row", "_row2", word), chosen, counts)
    pairs = hits.join(chosen, on=["anchor", "_salt"]).drop("_salt")
    return pairs.join(spoken, on=["_row", "_row2"])


def match_entities(texts: DataFrame, terms: DataFrame, text_id: str = "doc_id",
                   text: str = "text", key: str = "ticker",
                   keep: Sequence[str] = (), max_terms: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Pairs (key, text id) where the whole text contains a phrase of the entity.

    The texts' columns ``keep`` come along.

    The distinct words of each text meet the terms by equality with the anchor, and only such
    candidates are searched for the phrase: work grows with the texts plus the candidates, not with
    texts times entities. With a short list all of this runs inside the scan and only matches are
    shuffled. With a long list words and terms are shuffled without the texts, heavy words salted
    by their counts, and each text comes back by the hash of its row. Both ways give the same rows:
    repeated and null ids keep their own texts, and rows that are equal throughout count once. The
    words are counted by a job of its own when this is called.
    """
    # A phrase of one word is its own anchor and needs no search.
    said = (F.col("phrase") == F.col("anchor")) | F.contains("_text", _padded(F.col("phrase")))
    found = candidates(texts, terms, text_id, text, key, keep, max_terms).filter(said)
    same_row = ["_row", "_row2"]
    return found.select(key, text_id, *keep, *same_row).dropDuplicates(
        [key, *same_row]).drop(*same_row)
