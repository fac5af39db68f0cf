"""Scores of texts under a bigram model of the corpus, kept as Elias-Fano tries.

The model interpolates: p(w | u) = (c(uw) + k p(w)) / (c(u) + k), with the add-0.1 unigram p(w).
A trie has two levels: contexts u, and under each its following words. Contexts are one monotone
sequence, the pointers to where their words begin another; words are numbered in the trie, and
each context's numbers are raised by the last value of the context before, so that all of them are
a third. Beside each word stands log10 c(uw) / (c(u) + k) in eight bits. A lookup finds the context
by successor search, and the word by a successor search from the context's offset.

The trie is sharded by context, and the (at most ``FREQUENT``) contexts that make up more than a
1 / FREQUENT share of all tokens by context and word, so that no shard grows with a common word.
Texts come to the shards as requests: blocks of text ask once for each distinct word and pair they
hold, and get a byte back, so a pair in every text costs a request per block, not per text. Blocks
are written to the shared folder first, with words as numbers, so that what answers belong to
stays the same when executors are lost. Counts are over all training texts; nothing is pruned.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import as_bytes, blocks, release, small_batches, stored
from .elias_fano import EliasFano

ADD = 0.1
STRENGTH = 2.0  # k: how many tokens the unigrams weigh in a context
FREQUENT = 256
SHARD_BYTES = 4 << 20  # of text per shard, about
TEXT_BLOCK = 6 << 20  # bytes of text in a block
BEGIN, END = (np.uint64(xxhash.xxh3_64_intdigest(t)) for t in (b"\n<s>", b"\n</s>"))
# codes 1 to 255 of log10 of a share, 0 for none
_CODES, _LEAST = 255, -9.0


def _planes(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers byte by byte, so that their zero bytes compress."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, width).T).tobytes()


def _unplanes(data: bytes, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _short(hashes: np.ndarray) -> bytes:
    """The low five bytes of hashes."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unshort(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def quantise(shares: np.ndarray) -> np.ndarray:
    steps = np.rint((np.log10(shares) / _LEAST) * (_CODES - 1))
    return (1 + np.clip(steps, 0, _CODES - 1)).astype(np.uint8)


def share_of(codes: np.ndarray) -> np.ndarray:
    table = 10.0 ** (np.arange(-1, _CODES) * (_LEAST / (_CODES - 1)))
    table[0] = 0.0
    return table[codes]


class Trie:
    """Two levels over pairs (context, word); memory-mapped from a file."""

    def __init__(self, words: np.ndarray, contexts: EliasFano, pointers: EliasFano,
                 children: EliasFano, codes: np.ndarray):
        self.words, self.contexts, self.pointers = words, contexts, pointers
        self.children, self.codes = children, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> Trie:
        """From distinct pairs sorted by context, then word (word numbers from 1 by value)."""
        words = np.unique(word)
        number = np.searchsorted(words, word).astype(np.uint64) + np.uint64(1)
        contexts, begins = np.unique(context, return_index=True)
        ends = np.append(begins[1:], len(word))
        last = number[ends - 1] if len(word) else number
        raised = np.concatenate(([np.uint64(0)], np.cumsum(last)))[:len(contexts)]
        children = number + np.repeat(raised, ends - begins)
        return cls(words, EliasFano.build(contexts >> np.uint64(1)),
                   EliasFano.build(np.append(begins, len(word))), EliasFano.build(children), codes)

    def save(self, file) -> list[tuple[str, int, int]]:
        """Write all arrays one after another; returns their (type, offset, length)."""
        places = []
        for a in (self.words, self.codes, *self.contexts.arrays(), *self.pointers.arrays(),
                  *self.children.arrays()):
            file.write(b"\0" * (-file.tell() % 8))
            places.append((a.dtype.str, file.tell(), len(a)))
            file.write(a.tobytes())
        file.write(b"\0" * 8)
        file.flush()
        return places

    @classmethod
    def mapped(cls, file, places: list[tuple[str, int, int]]) -> Trie:
        whole = np.memmap(file, np.uint8, "r")
        a = [whole[at:at + n * np.dtype(kind).itemsize].view(kind) for kind, at, n in places]
        levels = [EliasFano(int(a[i][0]), int(a[i][1]), a[i + 1], a[i + 2]) for i in (2, 5, 8)]
        return cls(a[0], *levels, a[1])

    def look_up(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each pair, 0 where the trie does not have it."""
        out = np.zeros(len(word), np.uint8)
        if not len(self.words) or not len(word):
            return out
        key = context >> np.uint64(1)
        c = self.contexts.successor(key)
        number = np.searchsorted(self.words, word)
        known = (c < self.contexts.n) & (number < len(self.words))
        at = np.flatnonzero(known)
        at = at[(self.contexts.get(c[at]) == key[at]) & (self.words[number[at]] == word[at])]
        if not len(at):
            return out
        c = c[at]
        begin = self.pointers.get(c).astype(np.int64)
        end = self.pointers.get(c + 1).astype(np.int64)
        base = np.where(begin > 0, self.children.get(np.maximum(begin - 1, 0)), np.uint64(0))
        wanted = base + number[at].astype(np.uint64) + np.uint64(1)
        i = self.children.successor(wanted)
        inside = np.flatnonzero((i >= begin) & (i < end))
        hit = inside[self.children.get(i[inside]) == wanted[inside]]
        out[at[hit]] = self.codes[i[hit]]
        return out


def _blocks_of(docs: DataFrame) -> DataFrame:
    """(block, ids, held, sizes, tokens, vocabulary): texts as numbers of a block's own words.

    The last two words of a vocabulary are begin and end of a text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for n, part in enumerate(blocks(batches, "_text", TEXT_BLOCK)):
            seen: dict[bytes, int] = {}
            sizes, tokens = [], []
            for text in as_bytes(part.column("_text")):
                words = text.lower().split()
                sizes.append(len(words))
                tokens.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words),
                                          np.uint32, len(words)))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, seen), np.uint64, len(seen))
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + n], pa.int64()),
                 pa.array([part.column("_doc").to_pylist()], pa.list_(pa.int64())),
                 pa.array([part.column("_held").to_pylist()], pa.list_(pa.bool_())),
                 pa.array([_planes(np.array(sizes))], pa.binary()),
                 pa.array([_planes(np.concatenate(tokens))], pa.binary()),
                 pa.array([np.append(hashes, [BEGIN, END]).tobytes()], pa.binary())],
                ["block", "ids", "held", "sizes", "tokens", "vocabulary"])

    return docs.mapInArrow(run, "block bigint, ids array<bigint>, held array<boolean>, "
                           "sizes binary, tokens binary, vocabulary binary")


class _Block:
    """A block's texts; pairs run from begin to end of each text."""

    def __init__(self, row: dict):
        self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        self.sizes = _unplanes(row["sizes"]).astype(np.int64)
        self.train = ~np.array(row["held"], bool)
        self.tokens = _unplanes(row["tokens"]).astype(np.int64)

    def counts(self) -> np.ndarray:
        """How often each word stands in the training texts; end once a text."""
        held = np.repeat(self.train, self.sizes)
        out = np.bincount(self.tokens[held], minlength=len(self.vocabulary))
        out[-2:] = self.train.sum()
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, word, text) of every token and end, by numbers of words."""
        n = len(self.tokens) + len(self.sizes)
        ends = np.cumsum(self.sizes + 1) - 1
        word = np.full(n, len(self.vocabulary) - 1)
        inner = np.ones(n, bool)
        inner[ends] = False
        word[inner] = self.tokens
        context = np.empty(n, np.int64)
        context[1:] = word[:-1]
        context[ends - self.sizes] = len(self.vocabulary) - 2
        return context, word, np.repeat(np.arange(len(self.sizes)), self.sizes + 1)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(contexts, words, where each token's pair is, text of each token) of distinct pairs."""
        context, word, owner = self.pairs()
        pairs, where = np.unique(context << 32 | word, return_inverse=True)
        return pairs >> 32, pairs & 0xFFFFFFFF, where, owner


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    limits = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(limits)).tolist():
        yield s, order[limits[s]:limits[s + 1]]


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes % np.uint64(shards)).astype(np.int64)


def _pair_shard(context: np.ndarray, word: np.ndarray, frequent: np.ndarray,
                shards: int) -> np.ndarray:
    both = context * np.uint64(0x9E3779B97F4A7C15) + (word & np.uint64(0xFFFFFFFFFF))
    key = np.where(np.isin(context, frequent), both ^ (both >> np.uint64(31)), context)
    return _word_shard(key, shards)


def _word_answers(table: DataFrame, shards: int) -> DataFrame:
    """(shard, block, counts, total, distinct): corpus counts of each block's words of a shard;
    one row without a block holds the shard's sums."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                counts = block.counts()
                out = [(s, row["block"], block.vocabulary[own].tobytes(), _planes(counts[own]))
                       for s, own in _by_shard(_word_shard(block.vocabulary, shards), shards)]
                yield _batch(out, "shard bigint, block bigint, words binary, counts binary")

    def answer(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        words = np.concatenate([np.frombuffer(r["words"], np.uint64) for r in rows])
        counts = np.concatenate([_unplanes(r["counts"]) for r in rows]).astype(np.int64)
        known, where = np.unique(words, return_inverse=True)
        sums = np.zeros(len(known), np.int64)
        np.add.at(sums, where, counts)
        limits = np.cumsum([len(r["words"]) // 8 for r in rows])[:-1]
        out = [(r["shard"], r["block"], _planes(a, "<u8"), None, None, None)
               for r, a in zip(rows, np.split(sums[where], limits))]
        tokens = sums[(known != BEGIN) & (sums > 0)]
        top = np.argsort(-sums, kind="stable")[:FREQUENT]
        out.append((rows[0]["shard"], None, None, int(tokens.sum()), len(tokens),
                    known[top].tobytes() + sums[top].tobytes()))
        return pa.Table.from_batches([_batch(out, words_schema)])

    words_schema = ("shard bigint, block bigint, counts binary, total bigint, distinct bigint, "
                    "most binary")
    return table.mapInArrow(
        ask, "shard bigint, block bigint, words binary, counts binary",
    ).groupBy("shard").applyInArrow(answer, words_schema)


def _pair_answers(table: DataFrame, shards: int, frequent: np.ndarray, times: np.ndarray,
                  strength: float) -> DataFrame:
    """(shard, block, codes): the trie's code for each distinct pair of a block in a shard."""
    asked = "shard bigint, block bigint, contexts binary, children binary, words binary, counts binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                context, word, where, owner = block.distinct()
                counts = np.bincount(where, weights=block.train[owner], minlength=len(context))
                u, w = block.vocabulary[context], block.vocabulary[word]
                out = []
                for s, own in _by_shard(_pair_shard(u, w, frequent, shards), shards):
                    begins = np.flatnonzero(np.diff(context[own], prepend=-1))
                    out.append((s, row["block"], u[own[begins]].tobytes(),
                                _planes(np.diff(np.append(begins, len(own)))), _short(w[own]),
                                _planes(counts[own])))
                yield _batch(out, asked)

    def answer(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        u = np.concatenate([np.repeat(np.frombuffer(r["contexts"], np.uint64),
                                      _unplanes(r["children"])) for r in rows])
        w = np.concatenate([_unshort(r["words"]) for r in rows])
        counts = np.concatenate([_unplanes(r["counts"]) for r in rows]).astype(np.int64)
        limits = np.cumsum([len(r["words"]) // 5 for r in rows])[:-1]
        order = np.lexsort((w, u))
        u, w = u[order], w[order]
        new = np.ones(len(u), bool)
        new[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
        begins = np.flatnonzero(new)
        u, w, sums = u[begins], w[begins], np.add.reduceat(counts[order], begins)
        trie = _trie(u[sums > 0], w[sums > 0], sums[sums > 0], frequent, times, strength)
        with tempfile.TemporaryFile() as file:
            found = Trie.mapped(file, trie.save(file)).look_up(u, w)
        codes = np.empty(len(order), np.uint8)
        codes[order] = found[np.cumsum(new) - 1]
        del trie
        release()
        return pa.Table.from_batches([_batch(
            [(r["shard"], r["block"], c.tobytes()) for r, c in zip(rows, np.split(codes, limits))],
            "shard bigint, block bigint, codes binary")])

    return table.mapInArrow(ask, asked).groupBy("shard").applyInArrow(
        answer, "shard bigint, block bigint, codes binary")


def _trie(u: np.ndarray, w: np.ndarray, sums: np.ndarray, frequent: np.ndarray,
          times: np.ndarray, strength: float) -> Trie:
    """The trie of one shard from its distinct pairs, sorted, and their training counts."""
    contexts, where = np.unique(u, return_inverse=True)
    totals = np.bincount(where, weights=sums, minlength=len(contexts))
    # A frequent context's words lie in many shards; its count comes with it.
    at = np.searchsorted(frequent, contexts)
    at[at == len(frequent)] = 0
    if len(frequent):
        totals = np.where(frequent[at] == contexts, times[at], totals)
    return Trie.build(u, w, quantise(sums / (totals[where] + strength)))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64(),
             "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)],
        [name for name, _ in fields])


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text",
          strength: float = STRENGTH) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each whole text.

    Learned from the rows that are not ``held_out`` (null: held out). Words are parted by ASCII
    blanks after lower-casing A-Z; each text ends with one more token, its end. Null and empty
    texts are their end alone. ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1))); ``score``
    is the bigram model's log10 probability of the whole text. Words are told apart by 64-bit
    hashes. Repeated rows count as often as they stand. Without training rows c, N and V are 0.
    Ids are whole numbers.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("bigint").alias("_doc"),
                         F.coalesce(held_out, F.lit(True)).alias("_held"),
                         F.col(text).cast("string").alias("_text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    shards = max(4, math.ceil(size / SHARD_BYTES))
    table = stored(_blocks_of(source), "text-blocks")
    words = stored(_word_answers(table, shards), "word-counts")
    sums = words.filter("block IS NULL")
    n, v = (x or 0 for x in sums.agg(F.sum("total"), F.sum("distinct")).first())
    frequent, times = _frequent(sums, n)
    pairs = stored(_pair_answers(table, shards, frequent, times, strength), "pair-codes")
    answers = (
        words.filter("block IS NOT NULL").groupBy("block").agg(
            F.collect_list(F.struct("shard", "counts")).alias("counts"))
        .join(pairs.groupBy("block").agg(F.collect_list(F.struct("shard", "codes")).alias("codes")),
              "block"))
    schema = ("_doc bigint, held_out boolean, n_tokens bigint, n_known bigint, "
              "train_tokens bigint, base_score double, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _scored(row, shards, frequent, n, v, strength, schema)

    return table.join(answers, "block").mapInArrow(run, schema).withColumnRenamed("_doc", id_col)


def _frequent(sums: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The words that are more than a 1 / FREQUENT share of all tokens, sorted, and their counts;
    begin of text, which is as frequent as there are texts, always is among them."""
    found: dict[int, int] = {int(BEGIN): 0}
    for r in sums.select("most").toLocalIterator():
        words, times = np.frombuffer(r["most"], np.uint64).reshape(2, -1)
        for w, c in zip(words.tolist(), times.tolist()):
            if c * FREQUENT > n or w == int(BEGIN):
                found[w] = c
    words = np.array(sorted(found), np.uint64)
    return words, np.array([found[int(w)] for w in words], np.float64)


def _scored(row: dict, shards: int, frequent: np.ndarray, n: int, v: int, strength: float,
            schema: str) -> pa.RecordBatch:
    block = _Block(row)
    counts = np.zeros(len(block.vocabulary), np.int64)
    own = dict(_by_shard(_word_shard(block.vocabulary, shards), shards))
    for part in row["counts"]:
        counts[own[part["shard"]]] = _unplanes(part["counts"], "<u8")
    context, word, where, owner = block.distinct()
    codes = np.zeros(len(context), np.uint8)
    shard = _pair_shard(block.vocabulary[context], block.vocabulary[word], frequent, shards)
    own = dict(_by_shard(shard, shards))
    for part in row["codes"]:
        codes[own[part["shard"]]] = np.frombuffer(part["codes"], np.uint8)
    single = (counts + ADD) / (n + ADD * (v + 1))
    # A share near one may have been rounded up.
    both = np.minimum(share_of(codes) + strength / (counts[context] + strength) * single[word], 1.0)
    _, token, _ = block.pairs()
    texts = len(block.sizes)
    return pa.RecordBatch.from_arrays(
        [pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
         pa.array(block.sizes + 1),
         pa.array(np.bincount(owner, weights=counts[token] > 0, minlength=texts).astype(np.int64)),
         pa.array(np.full(texts, n, np.int64)),
         pa.array(np.bincount(owner, weights=np.log10(single)[token], minlength=texts)),
         pa.array(np.bincount(owner, weights=np.log10(both)[where], minlength=texts))],
        [f.split()[0] for f in schema.split(", ")])
