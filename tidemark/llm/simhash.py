"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint holds, per bit, the majority over the hashes of a text's shingles. To find pairs
that differ in at most r bits, every bit gets a vector of r + 1 bits, and every nonzero vector v of
that length is a table: it looks at the bits whose vector has an odd product with v. The up to r
differing bits give r equations in r + 1 unknowns, so some nonzero v is orthogonal to all of them:
its table sees none of the differences, and the pair collides there. No pair is lost.

A bucket with more than ``BUCKET`` fingerprints is not compared as it is: its members are dealt to
the same kind of tables over the bits that its own table does not look at, in which every close
pair of the bucket collides again. The members of a bucket agree in all bits seen so far, so once
``FREE`` bits are left there are at most 2^``FREE`` of them, whatever the data; nothing is capped.
Within a bucket each fingerprint is compared with those not linked yet, so n linked ones give n - 1
links, not n squared. A fingerprint stands for all its texts, however many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, blocks, small_batches, stored

BITS = 64
SEED = 42
BUCKET = 256  # larger buckets are dealt to further tables
FREE = 12  # until so few bits are left


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of one text: lower-cased A-Z, words parted by ASCII blanks, shingles of ``width``."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    last = max(len(words) - width, 0)
    stops = ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:last + 1].tolist(), stops.tolist())),
        np.uint64, last + 1)
    counts = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
            .sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each row's whole text as a signed 64-bit number."""
    small_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text"):
            values = [fingerprint(t, width) for t in as_bytes(part.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), pa.array(values, pa.int64())], ["_doc", "fp"])

    source = docs.select(F.col(id_col).alias("_doc"), F.col(text).cast("string").alias("_text"))
    kind = source.schema["_doc"].dataType.simpleString()
    return source.mapInArrow(run, f"_doc {kind}, fp bigint").withColumnRenamed("_doc", id_col)


def masks(radius: int, seen: int = 0) -> list[int]:
    """The tables' bit masks, one per nonzero vector of radius + 1 bits.

    A table looks at the bits of ``seen`` too; vectors are given to the others, the i-th one
    1 + i mod (2^(radius+1) - 1): all nonzero, evenly used.
    """
    size = 2 ** (radius + 1)
    free = [i for i in range(BITS) if not seen >> i & 1]
    return [seen | sum(1 << bit for i, bit in enumerate(free)
                       if ((1 + i % (size - 1)) & v).bit_count() % 2)
            for v in range(1, size)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _dealt(rows: DataFrame, tables: list[list[int]]) -> DataFrame:
    """(table, key, fp): each fingerprint in the tables that follow the one it is in."""
    options = F.array(*[F.array(*[F.struct(
        F.lit(n * len(group) + i).alias("table"), F.lit(_signed(m)).cast("bigint").alias("mask"))
        for i, m in enumerate(group)]) for n, group in enumerate(tables)])
    return (rows.select("fp", F.explode(options[F.col("table")]).alias("t"))
            .select("t.table", F.col("fp").bitwiseAND(F.col("t.mask")).alias("key"), "fp"))


def _forest(members: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Pairs within the radius that connect all members which such pairs connect."""
    a, b = [], []
    left = np.sort(members)
    while len(left) > 1:
        waiting, left = [left[:1]], left[1:]
        while waiting and len(left):
            for point in waiting.pop():
                near = np.bitwise_count(left ^ point) <= radius
                if near.any():
                    found = left[near]
                    a.append(np.minimum(found.view(np.int64), point.view(np.int64)))
                    b.append(np.maximum(found.view(np.int64), point.view(np.int64)))
                    waiting.append(found)
                    left = left[~near]
    return a, b


def _compared(buckets: DataFrame, radius: int) -> DataFrame:
    """(a, b): links of the buckets (members), each of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values = column.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(column.value_lengths().to_numpy())
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for members in np.split(values, ends[:-1]):
                low, high = _forest(members, radius)
                a += low
                b += high
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return buckets.mapInArrow(run, "a bigint, b bigint")


def links(points: DataFrame, radius: int) -> DataFrame:
    """(a, b), a < b: pairs of fingerprints within the radius that connect all that are linked.

    ``points`` has distinct fingerprints in ``fp``. Buckets are counted before they are listed.
    """
    small_batches(points.sparkSession)
    rows, tables, found = points.select("fp", F.lit(0).alias("table")), [0], None
    while True:
        groups = [masks(radius, seen) for seen in tables]
        tables = [m for group in groups for m in group]
        last = all(BITS - m.bit_count() <= FREE for m in tables)
        placed = stored(_dealt(rows, groups), "tables")
        sizes = placed.groupBy("table", "key").agg(F.count("*").alias("_n")).filter("_n > 1")
        shared = stored(placed.join(sizes, ["table", "key"]), "buckets")
        small = shared if last else shared.filter(F.col("_n") <= BUCKET)
        pairs = _compared(small.groupBy("table", "key").agg(
            F.collect_list("fp").alias("members")).select("members"), radius)
        found = pairs if found is None else found.unionByName(pairs)
        rows = shared.filter(F.col("_n") > BUCKET).select("fp", "table")
        if last or rows.isEmpty():
            return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of the edges (a, b).

    Each round a node takes the smallest root among its neighbours' and its own root's root, so
    chains shorten by doubling; rounds end when nothing changes. Each is written to the shared
    folder. Edges stay as they are: a node has at most as many as there are points within the
    radius, so no key of them is hot, and roots are looked up in a table with one row per node.
    """
    edges = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                   "links")
    roots = stored(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    while True:
        seen = roots.select(F.col("node").alias("b"), "root")
        offered = edges.join(seen, "b").groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("offer"))
        better = roots.join(offered, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "offer").alias("root"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        following = stored(better.join(jump, "root", "left").select(
            "node", F.least("root", "next").alias("root"),
            (F.least("root", "next") < F.col("old")).alias("moved")), "roots")
        if following.filter("moved").isEmpty():
            return following.select("node", "root")
        roots = following.select("node", "root")


def near_duplicate_groups(docs: DataFrame, width: int = 3, radius: int = 2,
                          id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    Null and empty texts and those of blanks have fingerprint zero, linked like any other; a text
    with fewer words than a shingle is one shingle. ``component_id`` is the smallest id that is
    reachable over links, null ids aside (null if all are null). Repeated rows give repeated rows.
    An empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, width, id_col, text), "fingerprints")
    points = stored(rows.groupBy("fp").agg(F.min(id_col).alias("first")), "points")
    roots = components(links(points.select("fp"), radius))
    grouped = points.join(roots, points.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    first = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    of_point = grouped.join(first, "root").select("fp", "component_id")
    return rows.join(of_point, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2,
                         id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the rows that stay: of each group those with its smallest id.

    Rows without an id stay.
    """
    gone = near_duplicate_groups(docs, width, radius, id_col, text).filter(
        F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("__id")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__id"), "left_anti")
