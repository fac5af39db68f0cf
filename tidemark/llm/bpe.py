"""Byte-level BPE by replaying the merges over many words of the corpus at once.

The distinct new words (matches of the split pattern) of a block lie side by side as linked bytes. An inverted index leads from each pair of neighbours that can merge,
by the rank of the merge, to the positions where it stands. Merges are applied in rank order, each
at all its positions; only the two neighbours of a merged pair are looked up again, and new pairs
enter the index.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from .common import blocks, small_batches
from .segments import CACHED, Recent, segments
from .word_bpe import Group

WORDS = 300_000  # words that a Python worker keeps
BLOCK = 4 << 20  # bytes of text whose new words are found together
REPLAYED = 100_000  # new words of one replay
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class _Pairs(dict):
    """Merge rank of two tokens a, b under a << 20 | b; -1 where they do not merge."""

    def __init__(self, ranks: dict[bytes, int], tokens: dict[int, bytes]):
        super().__init__()
        self.ranks, self.tokens = ranks, tokens

    def __missing__(self, pair: int) -> int:
        if len(self) > 500_000:
            self.clear()
        both = self.tokens[pair >> 20] + self.tokens[pair & 0xFFFFF]
        found = self[pair] = self.ranks.get(both, -1)
        return found


@dataclass
class Line:
    """Words side by side, by the place of each byte: what token starts there (-1 inside one), the
    places of the neighbours, the rank of the pair with the next token, and the word's number."""

    token: np.ndarray
    following: np.ndarray
    before: np.ndarray
    rank: np.ndarray
    word: np.ndarray


class Merges:
    """The ranks of a vocabulary: token ids are ranks; any two neighbours whose bytes together
    are a token can merge, whatever pair the token was made of."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)]
                                    for a in range(256)])
        self.pairs = _Pairs(ranks, self.tokens)
        pairs = {ranks[t[:k]] << 20 | ranks[t[k:]]: i for t, i in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.keys = np.array(sorted(pairs), np.int64)
        self.key_ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        return [np.frombuffer(ids, "<u4").tolist() for ids in self.packed(words)]

    def packed(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers."""
        done = {w: self.ranks[w].to_bytes(4, "little") for w in words if w in self.ranks}
        done[b""] = b""
        rest = [w for w in dict.fromkeys(words) if w not in done]
        if rest:
            done.update(zip(rest, self._merged(rest)))
        return [done[w] for w in words]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], -1)

    def _merged(self, words: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        following, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        following[ends - 1] = before[ends[:-1]] = -1
        rank = np.append(self.byte_pairs[data[:-1], data[1:]], -1)  # of the pair that starts here
        rank[ends - 1] = -1
        line = Line(self.byte_ids[data], following, before, rank, np.repeat(np.arange(len(words)), sizes))
        self._apply(line)
        # A merged token stands where its first byte stood, so tokens are still in order.
        alive = line.token >= 0
        ids = line.token[alive].astype("<u4").tobytes()
        limits = (4 * np.cumsum(alive)[ends - 1]).tolist()
        return [ids[a:b] for a, b in zip([0, *limits], limits)]

    def _apply(self, line: Line) -> None:
        """Every merge in rank order, at all its places at once; those of one word from the left."""
        index = {r: [at] for r, at in _by_rank(np.arange(len(line.rank)), line.rank)}
        order = list(index)
        heapq.heapify(order)
        while order:
            r = heapq.heappop(order)
            found = np.sort(np.concatenate(index.pop(r)))
            found = found[np.append(True, found[1:] != found[:-1])]
            while len(found := found[line.rank[found] == r]):  # else a neighbour has been merged
                word = line.word[found]
                first = np.append(True, word[1:] != word[:-1])
                for new, places in self._merge(line, found[first], r):
                    if new in index:
                        index[new].append(places)
                    else:
                        index[new] = [places]
                        heapq.heappush(order, new)
                found = found[~first]

    def _merge(self, line: Line, at: np.ndarray, r: int) -> Iterator[tuple[int, np.ndarray]]:
        """Merge the pairs at some places of different words; gives the new pairs' ranks and places."""
        gone = line.following[at]
        after, left = line.following[gone], line.before[at]
        line.token[at], line.token[gone], line.rank[gone], line.following[at] = r, -1, -1, after
        has_after, has_left = np.flatnonzero(after >= 0), np.flatnonzero(left >= 0)
        line.before[after[has_after]] = at[has_after]
        right_rank, left_rank = np.full(len(at), -1), np.full(len(at), -1)
        right_rank[has_after] = self.rank_of(
            np.full(len(has_after), r), line.token[after[has_after]])
        left_rank[has_left] = self.rank_of(line.token[left[has_left]], np.full(len(has_left), r))
        line.rank[at] = right_rank
        line.rank[left[has_left]] = left_rank[has_left]
        due = ((right_rank >= 0) & (right_rank < r)) | ((left_rank >= 0) & (left_rank < r))
        if due.any():  # at once, before what is left of this rank in the word
            for i in at[due].tolist():
                self._finish(line, i)
            right_rank[due] = left_rank[due] = -1
        return _by_rank(np.concatenate([left, at]), np.concatenate([left_rank, right_rank]))

    def _finish(self, line: Line, at: int) -> None:
        """Apply what is left to the word of a position, lowest rank and leftmost first."""
        while line.before[at] >= 0:
            at = int(line.before[at])
        places = [at]
        while (n := int(line.following[places[-1]])) >= 0:
            places.append(n)
        tokens = line.token[places].tolist()
        while len(tokens) > 1:
            ranks = [self.pairs[a << 20 | b] for a, b in zip(tokens, tokens[1:])]
            best = min((r for r in ranks if r >= 0), default=-1)
            if best < 0:
                break
            i = ranks.index(best)
            tokens[i:i + 2] = [best]
            line.token[places.pop(i + 1)] = -1
        line.token[places] = tokens
        line.rank[line.word == line.word[at]] = -1

    def spellings(self) -> tuple[pa.Array, pa.Array]:
        """Each id in decimal after a comma, and its bytes."""
        ids = range(max(self.tokens) + 1)
        return (pa.array([b",%d" % i for i in ids], pa.large_binary()),
                pa.array([self.tokens.get(i, b"") for i in ids], pa.large_binary()))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def unpacked(self, ids: bytes) -> bytes:
        """The bytes of ids given as little-endian 32-bit numbers."""
        return self.decode(np.frombuffer(ids, "<u4").tolist())


def _by_rank(places: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each rank with its places, -1 left out."""
    order = np.argsort(ranks, kind="stable")
    order = order[np.searchsorted(ranks[order], 0):]
    ranks, places = ranks[order], places[order]
    cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
    begins = [0, *cuts.tolist()] if len(ranks) else []
    return ((r, places[a:b]) for r, a, b in zip(
        ranks[np.array(begins, np.int64)].tolist(), begins, [*begins[1:], len(ranks)]))


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    with open(path, "rb") as f:
        return Merges({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})


class Words(Group):
    """Segments of texts with their ids; what tokens stand for is bytes."""

    def spelled(self, tokens: pa.Array) -> list[pa.Buffer]:
        nothing = pa.scalar(b"", tokens.type)
        segment = pc.binary_join(self._lists(self.id_ends, tokens.take(pa.array(self.ids))), nothing)
        texts = pc.binary_join(self._lists(self.ends, segment.take(self.word)), nothing)
        return [t.as_buffer() for t in texts]


class Encoder:
    """Segments of texts to ids; one per Python worker, which keeps the segments and the words it
    met lately. What is new in a block of texts is replayed together."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.split = merges, regex.compile(pattern)
        self.segments, self.words = Recent(CACHED), Recent(WORDS)

    def _replayed(self, parts: list[str]) -> list[bytes]:
        words = [[p] if p.isalpha() or p[:1] == " " and p[1:].isalpha() else self.split.findall(p)
                 for p in parts]  # letters alone, after one space, are one match
        new, known = self.words.missing(words), self.words.known
        for start in range(0, len(new), REPLAYED):
            part = new[start:start + REPLAYED]
            known.update(zip(part, self.merges.packed([w.encode() for w in part])))
        return [b"".join(map(known.__getitem__, ws)) for ws in words]

    def groups(self, texts: list[str]) -> Iterator[Words]:
        """The texts in order, so many at a time as make a block."""
        held, size = [], 0
        for i, text in enumerate(texts):
            held.append((i, segments(text)))
            size += len(text)
            if size >= BLOCK or i + 1 == len(texts):
                yield self._group(held)
                held, size = [], 0

    def _group(self, held: list[tuple[int, list[str]]]) -> Words:
        coded = pa.array(chain.from_iterable(parts for _, parts in held),
                         pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new, known = self.segments.missing([distinct]), self.segments.known
        known.update(zip(new, self._replayed(new)))
        packed = list(map(known.__getitem__, distinct))
        for _, parts in held:  # whole texts are not kept
            if len(parts) == 1:
                known.pop(parts[0], None)
        return Words([i for i, _ in held], np.cumsum([len(parts) for _, parts in held]),
                     coded.indices, np.frombuffer(b"".join(packed), "<i4"),
                     np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed))) // 4)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(merges_of(path), pattern)


def _strings(part: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in part.column("_text").to_pylist()]


def _encoded(part: pa.RecordBatch, path: str, pattern: str) -> list[bytes]:
    out = [b""] * part.num_rows
    for group in encoder(path, pattern).groups(_strings(part)):
        for i, ids in zip(group.text, group.ids_of_chunks()):
            out[i] = ids.astype("<u4").tobytes()
    return out


def _texts(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, str]:
    """(_doc, _text) and the type of the ids."""
    source = docs.select(F.col(id_col).alias("_doc"), F.col(text).cast("string").alias("_text"))
    return source, source.schema["_doc"].dataType.simpleString()


def encode(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN,
           id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): the token ids of each row's whole text, ids as little-endian 32-bit numbers.

    Null and empty texts have no ids. Special tokens are ordinary text. One row per row.
    """
    small_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text", BLOCK):
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), pa.array(_encoded(part, path, pattern), pa.binary())],
                ["_doc", "ids"])

    source, kind = _texts(docs, id_col, text)
    return source.mapInArrow(run, f"_doc {kind}, ids binary").withColumnRenamed("_doc", id_col)


def decode(encoded: DataFrame, path: str = RANKS, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the bytes that the ids stand for; null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_of(path)
        for part in blocks(batches, "ids"):
            out = [None if i is None else merges.unpacked(i)
                   for i in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), part.column("ids"), pa.array(out, pa.binary())],
                ["_doc", "ids", "decoded"])

    source = encoded.select(F.col(id_col).alias("_doc"), "ids")
    kind = source.schema["_doc"].dataType.simpleString()
    return source.mapInArrow(run, f"_doc {kind}, ids binary, decoded binary").withColumnRenamed(
        "_doc", id_col)


_DIGESTS = "_doc {}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "ids"):
            ids = [np.frombuffer(i, "<u4").tolist() for i in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), pa.array(list(map(len, ids)), pa.int64()),
                 pa.array([hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for i in ids]),
                 pa.array([hashlib.sha256(d).hexdigest()
                           for d in part.column("decoded").to_pylist()])],
                ["_doc", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = decoded.select(F.col(id_col).alias("_doc"), "ids", "decoded")
    kind = source.schema["_doc"].dataType.simpleString()
    return source.mapInArrow(run, _DIGESTS.format(kind)).withColumnRenamed("_doc", id_col)


def round_trip(docs: DataFrame, path: str = RANKS, pattern: str = public_tokenizers.PATTERN,
               id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): hashes of the ids in decimal, joined by commas, and
    of the decoded bytes, as ``decode(encode(docs))`` has them; both stay in the task."""
    small_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimals, spelled = merges_of(path).spellings()
        for part in blocks(batches, "_text", BLOCK):
            rows = [None] * part.num_rows
            for group in encoder(path, pattern).groups(_strings(part)):
                for i, ids, numbers, decoded in zip(
                        group.text, group.ids_of_chunks(), group.spelled(decimals),
                        group.spelled(spelled)):
                    rows[i] = (len(ids), hashlib.sha256(memoryview(numbers)[1:]).hexdigest(),
                               hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), *map(pa.array, zip(*rows))],
                ["_doc", "n_tokens", "ids_sha256", "decoded_sha256"])

    source, kind = _texts(docs, id_col, text)
    return source.mapInArrow(run, _DIGESTS.format(kind)).withColumnRenamed("_doc", id_col)
