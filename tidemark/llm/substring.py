"""Passages that stand in an earlier document, found behind a count-min prefilter.

A passage is a window of ``width`` consecutive words. First every task sketches its windows: cells
of a count-min sketch, one per row of it, that hold whether windows fell there once or more often.
The sketches are merged, and what is left is one bit per cell: reached at least twice. A window
with a bit unset in any row is surely alone, as the sketch only overestimates. The second pass
groups the others exactly, by 96 bits of two window hashes. The sketch grows with the text up to
``MAX_BITS`` cells a row (64 MB in all, the bound of what is broadcast); beyond that more single
windows pass the filter and are grouped for nothing, but none is lost.

Within a block of text a window that several documents share is settled at once but for the
smallest document; so a passage that half of all documents share reaches its group once per
block, not once per document. What is settled needs no group and is dealt out by document, so the
spans of many copies of one text spread over all groups. Groups are sorted by hash, never paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, blocks, small_batches, stored

WIDTH = 13
ROWS = 2  # of the sketch
RUN = 4  # words of the runs that decide a window's group
MAX_BITS = 28  # at most 2^28 cells a row
SLICE_BITS = 22  # cells of a row that one task merges at a time
BLOCK = 2 << 20  # bytes of text whose windows are held together
SHARD_BYTES = 4 << 20  # text whose windows one group of the second pass holds, about

_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two independent hashes of each word: sums of what its bytes mix to with their places in it.

    A place changes what a byte gives beyond any rule, so no two words agree by their structure, as
    words can under polynomials modulo 2^64.
    """
    sizes = ends - starts
    limits = np.cumsum(sizes)
    at = np.arange(limits[-1]) - np.repeat(limits - sizes, sizes)
    letters = (at.astype(np.uint64) << np.uint64(8)) | data[np.repeat(starts, sizes) + at]
    return [np.add.reduceat(_mix(letters, seed), limits - sizes) for seed in (31, 47)]


def windows(texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(hash, second hash, home, index of the text, word position) of every window of every text.

    The home is the smallest hash of the window's runs of ``RUN`` words, so that neighbours mostly
    share it: it decides which group a window goes to, and a text's windows reach few groups.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = ~_BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if len(starts) < width:
        none = np.zeros(0, np.uint64)
        return none, none, none, none.astype(np.int64), none.astype(np.int64)
    words, others = _word_hashes(data, starts, ends)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    owner = np.searchsorted(begins, starts, side="right") - 1
    first = np.searchsorted(owner, np.arange(len(texts)))
    n = len(words) - width + 1
    whole = np.flatnonzero(owner[:n] == owner[width - 1:])
    hashes = []
    for lane, (base, own) in enumerate(zip(_BASES, (words, others))):
        mixed = _mix(own, lane + 1)
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total = total * base + mixed[i:n + i]
        hashes.append(_mix(total[whole], lane + 11))
    run = min(RUN, width)
    runs = np.zeros(len(words) - run + 1, np.uint64)
    for i in range(run):
        runs = runs * _BASES[1] + words[i:len(runs) + i]
    runs = _mix(runs, 21)
    home = runs[:n].copy()
    for i in range(1, width - run + 1):
        np.minimum(home, runs[i:n + i], out=home)
    owner = owner[whole]
    return hashes[0], hashes[1], home[whole], owner, whole - first[owner]


def _cells(hashes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    return [(h >> np.uint64(64 - bits)).astype(np.int64) for h in hashes]


def _packed(cells: np.ndarray) -> bytes:
    """Sorted numbers as differences, as narrow as they fit."""
    steps = np.diff(cells, prepend=0)
    kind = np.uint16 if len(steps) and steps.max() < 1 << 16 else np.uint32
    return kind().itemsize.to_bytes(1, "little") + steps.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    kind = np.uint16 if data[0] == 2 else np.uint32
    return np.cumsum(np.frombuffer(data, kind, offset=1), dtype=np.int64)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, so that runs of zeros compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def sketch(texts: DataFrame, width: int, bits: int) -> list[np.ndarray]:
    """Per row of the sketch one bit per cell: two windows or more fell there.

    What comes to the driver are ROWS * 2^bits bits, at most 64 MB.
    """
    part_bits = min(bits, SLICE_BITS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text", BLOCK):
            hashes = windows(as_bytes(part.column("_text")), width)[:2]
            out: list[tuple[int, int, bytes, bytes]] = []
            for row, cells in enumerate(_cells(list(hashes), bits)):
                cells, times = np.unique(cells, return_counts=True)
                limits = np.searchsorted(cells, np.arange((1 << bits - part_bits) + 1) << part_bits)
                for s, (a, b) in enumerate(zip(limits, limits[1:])):
                    if a < b:
                        own = cells[a:b] - (s << part_bits)
                        out.append((row, s, _packed(own), _packed(own[times[a:b] > 1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()),
                 pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.binary())],
                ["row", "slice", "once", "more"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, s, once, more in zip(*[c.to_pylist() for c in batch.columns]):
                held = counts.setdefault((row, s), np.zeros(1 << part_bits, np.uint8))
                cells = _unpacked(once)
                held[cells] = np.minimum(held[cells] + 1, 2)
                held[_unpacked(more)] = 2
        for (row, s), held in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([row], pa.int32()), pa.array([s], pa.int32()),
                 pa.array([np.packbits(held > 1, bitorder="little").tobytes()], pa.binary())],
                ["row", "slice", "bits"])

    merged = (texts.select("_text")
              .mapInArrow(place, "row int, slice int, once binary, more binary")
              .repartition("row", "slice")
              .mapInArrow(merge, "row int, slice int, bits binary"))
    out = [np.zeros(max(1 << bits - 3, 1), np.uint8) for _ in range(ROWS)]
    size = max(1 << part_bits - 3, 1)
    for r in stored(merged, "sketch").toLocalIterator():
        out[r["row"]][r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, where groups of equal keys begin in that order)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def _smallest(values: np.ndarray, order: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each element the smallest value in its group."""
    low = np.minimum.reduceat(values[order], begins)
    out = np.empty_like(values)
    out[order] = np.repeat(low, np.diff(np.append(begins, len(order))))
    return out


_FOUND = "shard int, doc bigint, content bigint, first binary, second binary, docs binary, at binary"
_SPANS = "doc bigint, content bigint, at binary"


def dealt_windows(texts: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of the second pass with their shard: per document the spans settled in its block
    (docs is null), and per block and shard the windows still open."""
    small_batches(texts.sparkSession)
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    bits = int(min(max(math.ceil(math.log2(size / 3 + 1)), 10), max_bits))
    shards = max(8, math.ceil(size / SHARD_BYTES))
    filters = texts.sparkSession.sparkContext.broadcast(sketch(texts, width, bits))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text", BLOCK):
            docs = part.column("_doc").to_numpy(zero_copy_only=False)
            content = part.column("_content").to_numpy(zero_copy_only=False)
            first, second, home, owner, at = windows(as_bytes(part.column("_text")), width)
            maybe = np.ones(len(first), bool)
            for kept, cells in zip(filters.value, _cells([first, second], bits)):
                maybe &= (kept[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
            first, second = first[maybe], second[maybe].astype(np.uint32)
            home, owner, at = home[maybe], owner[maybe], at[maybe]
            if not len(first):
                continue
            low = _smallest(docs[owner], *_grouped(first, second))
            done = docs[owner] > low
            out: list[tuple] = []
            for o, positions in _by(owner[done], at[done]):
                doc, text = int(docs[o]), int(content[o])
                out.append((hash((doc, text)) % shards, doc, text, None, None, None, _planes(positions)))
            first, second, home, owner, at = (
                x[~done] for x in (first, second, home, owner, at))
            shard = (_mix(home, 31) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            limits = np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(limits)):
                own = order[limits[s]:limits[s + 1]]
                who, times = np.unique(owner[own], return_counts=True)
                table = np.stack([docs[who], content[who], times]).astype(np.int64)
                out.append((int(s), None, None, first[own].tobytes(), second[own].tobytes(),
                            table.tobytes(), _planes(at[own])))
            yield _rows(out, _FOUND)

    return texts.select("_doc", "_content", "_text").mapInArrow(find, _FOUND)


def repeated_windows(texts: DataFrame, width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc, content, spans): word positions of windows that also start in a smaller document.

    ``texts`` has _doc (a number), _content (a hash of the text) and _text.
    """
    def settle(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        kept = [i for i, d in enumerate(rows["docs"]) if d is None]
        out = [(rows["doc"][i], rows["content"][i], rows["at"][i]) for i in kept]
        open_rows = [i for i, d in enumerate(rows["docs"]) if d is not None]
        if open_rows:
            def all_of(name, kind):
                return np.concatenate([np.frombuffer(rows[name][i], kind) for i in open_rows])
            tables = [np.frombuffer(rows["docs"][i], np.int64).reshape(3, -1) for i in open_rows]
            doc, content = (np.concatenate([np.repeat(t[k], t[2]) for t in tables]) for k in (0, 1))
            at = np.concatenate([_unplanes(rows["at"][i]) for i in open_rows])
            order, begins = _grouped(all_of("first", np.uint64), all_of("second", np.uint32))
            later = doc > _smallest(doc, order, begins)
            doc, content, at = doc[later], content[later], at[later]
            if len(doc):
                order, begins = _grouped(doc, content)
                for own in np.split(order, begins[1:]):
                    out.append((int(doc[own[0]]), int(content[own[0]]), _planes(at[own])))
        return pa.Table.from_batches([_rows(out, _SPANS)])

    return (dealt_windows(texts, width, max_bits)
            .groupBy("shard").applyInArrow(settle, _SPANS)
            .groupBy("doc", "content").agg(F.collect_list("at").alias("spans")))


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], _ARROW[kind]) for i, (_, kind) in enumerate(fields)],
        [name for name, _ in fields])


def _by(owner: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions per owner; owners come in order."""
    if len(owner):
        who, begins = np.unique(owner, return_index=True)
        yield from zip(who.tolist(), np.split(at, begins[1:]))


def _without(text: bytes, spans: list[bytes] | None, width: int) -> tuple[bytes, int, int]:
    words = text.split()
    if not spans:
        return b" ".join(words), len(words), 0
    edge = np.zeros(len(words) + 1, np.int64)
    for at in spans:
        at = _unplanes(at).astype(np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + width, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return (b" ".join(w for w, c in zip(words, covered.tolist()) if not c),
            len(words), int(covered.sum()))


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
                   text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """All rows and columns, with ``kept_text``, ``n_words`` and ``n_removed`` (existing columns of
    these names are replaced).

    ``kept_text`` has the words that stay, joined by one blank. A word goes when a window that
    covers it also starts in a row with a smaller id; windows are judged on the input. A null text
    has no words; texts shorter than a window lose none. Rows without an id neither lose words nor
    make others lose any. Rows that share an id do not affect each other. Ids are whole numbers.
    """
    made = ("kept_text", "n_words", "n_removed")
    carried = [c for c in docs.columns if c not in made]
    keyed = docs.select(*carried, F.col(id_col).cast("bigint").alias("__doc"),
                        F.xxhash64(F.col(text)).alias("__content"))
    spans = repeated_windows(
        keyed.filter(f"__doc IS NOT NULL AND `{text}` IS NOT NULL").select(
            F.col("__doc").alias("_doc"), F.col("__content").alias("_content"),
            F.col(text).alias("_text")), width, max_bits)
    spans = spans.select(F.col("doc").alias("__d"), F.col("content").alias("__c"),
                         F.col("spans").alias("__spans"))
    joined = keyed.join(
        spans, (F.col("__doc") == F.col("__d")) & (F.col("__content") == F.col("__c")), "left",
    ).select(*carried, "__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text):
            done = [_without(t, s, width) for t, s in zip(
                as_bytes(part.column(text)), part.column("__spans").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in carried],
                 pa.array([d[0] for d in done], pa.binary()).cast(pa.string()),
                 pa.array([d[1] for d in done], pa.int64()),
                 pa.array([d[2] for d in done], pa.int64())], [*carried, *made])

    schema = docs.select(*carried).schema
    for name, kind in zip(made, ("string", "long", "long")):
        schema = schema.add(name, kind)
    return joined.mapInArrow(run, schema)


def without_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id",
                    text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows and columns; texts that lose words become what is left of them, and their
    ``length``, where there is such a column, the number of its characters."""
    made = ("kept_text", "n_words", "n_removed")
    own = {c: f"__own_{c}" for c in made if c in docs.columns}
    done = remove_repeats(docs.withColumnsRenamed(own), width, id_col, text)
    cut = F.col("n_removed") > 0
    done = done.withColumn(text, F.when(cut, F.col("kept_text")).otherwise(F.col(text)))
    if length in docs.columns:
        kind = docs.schema[length].dataType
        done = done.withColumn(length, F.when(cut, F.char_length(text).cast(kind)).otherwise(F.col(length)))
    return done.drop(*made).withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)
