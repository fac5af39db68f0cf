"""Harmonic packing of token sequences.

Lengths fall into classes by reciprocals of the capacity: class k holds the lengths in
(capacity / (k + 1), capacity / k], and a bin of class k is k pieces. A document gives full bins
(class 1) first. What is left goes whole into its class k if k pieces of its length leave at most a
``SPARE``-th of the bin unused; otherwise capacity // (k + 1) ids are cut off, which fill their
class but for at most k, and the rest is looked at in the same way. Every worker fills its bins by
itself; only at the end of a partition are bins open, at most one per class, and their pieces are
laid end to end, cut at the capacity, and the last bin at powers of two, so that those need no
padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from .common import blocks, small_batches

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 0
CAPACITY = 1024
BLOCK = 2 << 20  # bytes of text whose pieces are sent on together
SPARE = 32  # a piece is not cut further if bins of its like leave no more than this part of them
BLANKS = 50_000  # a run of so many blanks goes to the tokenizer; the rank encoder's stack ends below a million

_LONG_BLANK = re.compile(rf"(?<!\s)\s{{{BLANKS}}}")

Piece = tuple[object, int, bytes, int]  # document id, start, ids, tokens of the document


class Packer:
    """Bins of one worker; yields (piece, sequence, offset) as bins are filled."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[Piece]] = {}

    def add(self, doc: object, ids: bytes) -> Iterator[tuple[Piece, int, int]]:
        n, start = len(ids) // 4, 0
        while start < n:
            size = self._cut(n - start)
            piece = (doc, start, ids[4 * start:4 * (start + size)], n)
            k = self.capacity // size
            held = self.open.setdefault(k, [])
            held.append(piece)
            if len(held) == k:
                yield from self._bin(self.open.pop(k))
            start += size

    def _cut(self, left: int) -> int:
        if left >= self.capacity:
            return self.capacity
        k = self.capacity // left
        spare = self.capacity - k * left
        longest = left == self.capacity // k  # of its class
        return left if longest or spare * SPARE <= self.capacity else self.capacity // (k + 1)

    def _bin(self, pieces: list[Piece]) -> Iterator[tuple[Piece, int, int]]:
        offset = 0
        for piece in pieces:
            yield piece, self.next, offset
            offset += len(piece[2]) // 4
        self.next += 1

    def finish(self) -> Iterator[tuple[Piece, int, int]]:
        """The open bins' pieces, cut to full bins and powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) // 4 for p in left)
        room, held = 0, []
        for doc, start, ids, n in left:
            while ids:
                if not room:
                    room = self.capacity
                    while room > total:
                        room //= 2
                size = min(room, len(ids) // 4)
                held.append((doc, start, ids[:4 * size], n))
                start, ids = start + size, ids[4 * size:]
                room, total = room - size, total - size
                if not room:
                    yield from self._bin(held)
                    held = []


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], bytes]:
    """Ids of a text as little-endian 32-bit numbers; one encoder per Python worker.

    Where the file's merges make its tokens in the order of their ids, the merge rank of two tokens
    is the id of what they make, and the faster rank encoder gives the tokenizer's own ids. Texts
    with the string of a special token or a long run of blanks, and other files, go to the
    tokenizer itself.
    """
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    ranks = _ranks(json.loads(tokenizer.to_str()))

    def slow(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    if ranks is None:
        return slow
    quick = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN,
                              mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> bytes:
        if any(s in text for s in special) or len(text) >= BLANKS and _LONG_BLANK.search(text):
            return slow(text)
        return np.array(quick.encode_ordinary(text), "<u4").tobytes()

    return encode


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Token bytes to ids of a plain byte-level tokenizer whose ids are in the order of merges."""
    plain = spec.get("pre_tokenizer") or {}
    if (spec.get("normalizer") or plain.get("type") != "ByteLevel" or plain.get("add_prefix_space")
            or not plain.get("use_regex", True) or spec["model"]["type"] != "BPE"):
        return None
    vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    if made != list(range(256, 256 + len(merges))):
        return None
    # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in own}
    signs |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    return {bytes(signs[c] for c in t): i for t, i in vocabulary.items() if i < 256 + len(merges)}


def pack(docs: DataFrame, path: str = TOKENIZER, end: int = END, capacity: int = CAPACITY,
         id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids (binary), doc_tokens, sequence_id, offset.

    ``path`` is a byte-level tokenizer with the public split pattern. A document is the ids of its
    whole text (null: none) and the id ``end``. ``capacity`` is a power of two. Sequence ids are
    the partition's number times 2^40 and more, so workers need no common counter. Repeated rows
    are packed each. An empty table gives no pieces.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        last = np.array([end], "<u4").tobytes()
        for part in blocks(batches, "_text", BLOCK):
            texts = ["" if t is None else t for t in part.column("_text").to_pylist()]
            yield batch([p for doc, t in zip(part.column("_doc").to_pylist(), texts)
                         for p in packer.add(doc, encode(t) + last)])
        yield batch(list(packer.finish()))

    def batch(placed: list[tuple[Piece, int, int]]) -> pa.RecordBatch:
        pieces = [p for p, _, _ in placed]
        numbers = [pa.array(v, pa.int64()) for v in (
            [p[1] for p in pieces], [len(p[2]) // 4 for p in pieces], [p[3] for p in pieces],
            [s for _, s, _ in placed], [o for _, _, o in placed])]
        start, length, n, sequence, offset = numbers
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pieces], id_type), start, length,
             pa.array([p[2] for p in pieces], pa.binary()),
             pa.array([zlib.crc32(p[2]) for p in pieces], pa.int64()), n, sequence, offset],
            ["_doc", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    source = docs.select(F.col(id_col).alias("_doc"), F.col(text).cast("string").alias("_text"))
    id_type = to_arrow_type(source.schema["_doc"].dataType)
    kind = source.schema["_doc"].dataType.simpleString()
    return source.mapInArrow(
        run, f"_doc {kind}, start bigint, length bigint, ids binary, ids_crc32 bigint, "
        "doc_tokens bigint, sequence_id bigint, offset bigint").withColumnRenamed("_doc", id_col)
