"""Fill-in-the-middle by one match of a pattern that counts.

A text is cut after ``a`` and after ``b`` of its ``n`` units, the code points. ``regexp_count`` gives
``n``, and hashes of the document's id choose the cuts and the form. A pattern made for the row,
possessive ``unit{a}``, ``unit{b-a}`` and the rest, captures prefix, middle and suffix in one match,
which never backtracks, and the replacement sets them out in the form's order:

    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle
    plain   the text itself

Plain are empty texts, texts that hold one of the marks, and a share of the rest. No mark begins as
another ends, so the first mark of each kind is the one that was set, and the text can be rebuilt.
All of it is built-in functions over one row at a time, without a shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

# The marks, and out of a hundred texts those that are cut, and of these in spm.
PREFIX, SUFFIX, MIDDLE = MARKS = "<P>", "<S>", "<M>"
CUT, SPM = 90, 20
SEED = "1:"

UNIT = "."  # a code point, in patterns that begin with the flag s
# The units are counted in runs of so many first, and singly in what is left after them.
RUN = 64

_ORDERS = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
_RESTORED = {
    "psm": (rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2"),
    "spm": (rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1"),
}


def units(text: Column) -> Column:
    """The number of code points of a text.

    ``regexp_count`` makes an array of its matches, so whole runs count as one match each, and only
    the part of a run at the end is counted singly.
    """
    runs = F.regexp_count(text, F.lit(f"(?s){UNIT}{{{RUN}}}+"))
    rest = F.regexp_extract(text, rf"(?s)\A(?:{UNIT}{{{RUN}}}+)*+({UNIT}*+)\z", 1)
    return runs.cast("long") * RUN + F.regexp_count(rest, F.lit(f"(?s){UNIT}"))


def _hash(digest: Column, group: int) -> Column:
    """A group of eight hex digits as a number, groups from 1."""
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    return reduce(
        lambda rest, kind: F.when(form == kind, F.regexp_replace(output, *map(F.lit, _RESTORED[kind])))
        .otherwise(rest), _RESTORED, output)


def transform(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: str = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of each row's whole text.

    Null texts count as empty, and a null id is hashed as an empty one. Rows that share an id are cut
    alike by their shares of the hash; every row gives one row. Lengths are null for plain texts.
    Other columns are left out, so their names cannot clash.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    counted = docs.select(F.col(id_col), whole.alias("_text"), digest.alias("_digest")).withColumn(
        "n", units(F.col("_text")))
    h = [_hash(F.col("_digest"), i) for i in range(1, 5)]
    marked = reduce(or_, [F.contains("_text", F.lit(m)) for m in MARKS])
    cut = counted.withColumns({
        "_c1": h[0] % (F.col("n") + 1), "_c2": h[1] % (F.col("n") + 1),
        "form": F.when((F.col("_text") == "") | marked | (h[2] % 100 >= CUT), "plain")
        .when(h[3] % 100 < SPM, "spm").otherwise("psm"),
    })
    sized = cut.withColumns({
        "prefix_chars": F.when(F.col("form") != "plain", F.least("_c1", "_c2")),
        "middle_chars": F.when(F.col("form") != "plain", F.abs(F.col("_c1") - F.col("_c2"))),
    })
    pattern = F.format_string(rf"(?s)\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)({UNIT}*+)\z",
                              F.col("prefix_chars"), F.col("middle_chars"))
    order = F.when(F.col("form") == "spm", _ORDERS["spm"]).otherwise(_ORDERS["psm"])
    output = F.when(F.col("form") == "plain", F.col("_text")).otherwise(
        F.regexp_replace(F.col("_text"), pattern, order))
    return sized.select(id_col, "n", "form", "prefix_chars", "middle_chars", output.alias("output"))


def digests(transformed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Hashes of the outputs and of the texts rebuilt from them in place of the outputs."""
    return transformed.select(
        id_col, "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
