"""BPE over words with an end mark, by contiguous arrays of adjacent ranks.

A word is its bytes, the last one with the end mark. A short word holds its parts in one array and
the merge ranks of neighbouring parts in another; the least rank, the leftmost of equals, is looked
up, the boundary there is deleted, and the ranks of the two neighbours are refreshed, until nothing
merges. New words of a block that have the same length are the rows of one matrix: every row loses
exactly one boundary a step, so the matrix stays rectangular, and rows that are done leave it. The
scan is quadratic in the word, so a word above ``SHORT`` bytes goes through a heap of its ranks,
in some 200 bytes of memory a byte of the word.

Texts are normalised and split into words as the tokenizer's file says. Up to U+04FF the standard
library does the same by classes of its own tables; a chunk with other letters goes to the
tokenizer's own normaliser and splitter, whose tables are of another edition. Strings of special
tokens are those tokens.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import blocks, small_batches
from .segments import Recent

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SHORT = 48  # bytes of a word that is scanned for its minimum
WORDS = 200_000  # words that a Python worker keeps, in each of two generations
BLOCK = 2 << 20  # bytes of text whose new words are merged together
CHUNK = 1 << 16  # letters that are normalised and split at a time
NONE = np.iinfo(np.int32).max  # rank of what does not merge

PLAIN = 0x500  # letters below it are classed alike by all tables
# Beyond them, and capital sigma, which the standard library lowers by what stands after it.
_NOTHING = pa.scalar("", pa.large_string())
_OTHER = re.compile(f"[^\x00-{chr(PLAIN - 1)}]|Σ")


def _byte_letters() -> list[str]:
    """The letter of each byte: printable Latin-1 itself, the rest in order from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def _class(kinds: str) -> str:
    """The plain letters of the general categories that begin with one of ``kinds``."""
    return "".join(re.escape(chr(c)) for c in range(PLAIN)
                   if unicodedata.category(chr(c))[0] in kinds)


class Merges:
    """Vocabulary and merges; ids are numbers below the vocabulary's size."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]], end: str):
        letters = _byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters])
        self.last = np.array([vocabulary[c + end] for c in letters])
        pairs = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b])
                 for rank, (a, b) in enumerate(merges)}
        self.size = max(vocabulary.values()) + 1
        keys = np.array([a * self.size + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in pairs.values()], np.int32)[order]
        self.merged = np.zeros(len(merges), np.int64)
        for rank, token in pairs.values():
            self.merged[rank] = token
        self.pairs = pairs

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers."""
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        out = [b""] * len(words)
        for n, found in by_length.items():
            same = [words[i] for i in found]
            ids = self._long(same) if n > SHORT else self._short(same, n) if n else [b""]
            for i, packed in zip(found, ids):
                out[i] = packed
        return out

    def _parts(self, words: list[bytes], n: int) -> np.ndarray:
        data = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), n)
        parts = self.inner[data]
        parts[:, -1] = self.last[data[:, -1]]
        return parts

    def _short(self, words: list[bytes], n: int) -> list[bytes]:
        """Words of ``n`` bytes: a row of parts and a row of ranks of neighbours each."""
        out = [b""] * len(words)

        def give(numbers: np.ndarray, parts: np.ndarray) -> None:
            data, width = parts.astype("<u4").tobytes(), 4 * parts.shape[1]
            for j, i in enumerate(numbers.tolist()):
                out[i] = data[j * width:(j + 1) * width]

        number, parts = np.arange(len(words)), self._parts(words, n)
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        for left in range(n, 1, -1):  # parts of every row that is still held
            at = ranks.argmin(1)  # the leftmost of equals
            least = ranks[np.arange(len(at)), at]
            done = least == NONE
            if done.any():
                give(number[done], parts[done])
                number, parts, ranks, at, least = (
                    a[~done] for a in (number, parts, ranks, at, least))
            if not len(number):
                return out
            row = np.arange(len(number))
            parts[row, at] = self.merged[least]
            kept = np.ones(parts.shape, bool)
            kept[row, at + 1] = False
            parts = parts[kept].reshape(len(row), left - 1)
            kept = np.ones(ranks.shape, bool)
            kept[row, at] = False
            ranks = ranks[kept].reshape(len(row), left - 2)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < left - 2)
            for r, i in ((before, at[before] - 1), (after, at[after])):
                ranks[r, i] = self.rank(parts[r, i], parts[r, i + 1])
        give(number, parts)
        return out

    def _long(self, words: list[bytes]) -> list[bytes]:
        return [np.array(self._by_heap(w), "<u4").tobytes() for w in words]

    def _by_heap(self, word: bytes) -> list[int]:
        parts = self._parts([word], len(word))[0]
        n, size = len(parts), self.size
        ranks = self.rank(parts[:-1], parts[1:])
        parts = parts.tolist()
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        due = [r * n + i for i, r in enumerate(ranks.tolist()) if r != NONE]
        heapq.heapify(due)
        merged, none = self.merged.tolist(), (None, None)
        while due:
            rank, i = divmod(heapq.heappop(due), n)
            j = following[i]
            if parts[i] < 0 or j >= n or self.pairs.get((parts[i], parts[j]), none)[0] != rank:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = merged[rank], -1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (pair := (parts[a], parts[b])) in self.pairs:
                    heapq.heappush(due, self.pairs[pair][0] * n + a)
        return [p for p in parts if p >= 0]


class Vocabulary:
    """What a tokenizer's file says: words of a text, ids of words, tokens of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model, added = said["model"], said["added_tokens"]
        split = said["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens must be plain strings")
        self.merges = Merges(model["vocab"], [tuple(m) for m in model["merges"]],
                             model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in added}
        self.tokens = {i: t for t, i in (model["vocab"] | self.special).items()}
        self.library = Tokenizer.from_file(path)
        classes = {r"\p{L}": _class("L"), r"\p{N}": _class("N"), r"\s": r"\t-\r \x85\xa0"}
        for group, letters in classes.items():
            split = split.replace(group, letters)
        self.split = re.compile(split)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.find_special = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        self.letter_byte = {ord(c): b for b, c in enumerate(_byte_letters())}

    def spellings(self) -> tuple[pa.Array, pa.Array]:
        """Each id in decimal, and its token, a blank before it."""
        ids = range(max(self.tokens) + 1)
        return tuple(pa.array([f" {t}" for t in spelled], pa.large_string())
                     for spelled in (ids, [self.tokens.get(i, "") for i in ids]))

    def words(self, text: str) -> list[str]:
        """The words of a chunk; a special token is its string after a blank, as no word has one."""
        if not self.find_special.search(text):
            return self._plain_words(text)
        out = []
        for i, piece in enumerate(self.find_special.split(text)):
            out.extend([" " + piece] if i % 2 else self._plain_words(piece))
        return out

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return self.split.findall(text.lower())
        if not _OTHER.search(text):
            normal = unicodedata.normalize("NFC", text).lower()
            if not _OTHER.search(normal):
                return self.split.findall(normal)
        normal = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [w.translate(self.letter_byte).encode("latin-1").decode() for w, _ in found]

    def encode(self, words: list[str]) -> list[bytes]:
        plain = [w for w in words if not w.startswith(" ")]
        ids = dict(zip(plain, self.merges.encode([w.encode() for w in plain])))
        return [self.special[w[1:]].to_bytes(4, "little") if w.startswith(" ") else ids[w]
                for w in words]


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


def chunks(text: str) -> Iterator[str]:
    """The text in parts that begin at spaces, which no word and no normalisation crosses."""
    start = 0
    while len(text) - start > CHUNK:
        cut = text.rfind(" ", start + 1, start + CHUNK)
        if cut < 0:
            cut = text.find(" ", start + CHUNK)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


@dataclass
class Group:
    """Chunks of texts with their words: each distinct word's ids, and its places in order."""

    text: list[int]  # number of each chunk's text
    ends: np.ndarray  # where the words of each chunk end
    word: pa.Array  # number of the distinct word at each place
    ids: np.ndarray  # of all distinct words, one after another
    id_ends: np.ndarray

    def _lists(self, ends: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.LargeListArray.from_arrays(np.concatenate([[0], ends]), values)

    def ids_of_chunks(self) -> list[np.ndarray]:
        words = self._lists(self.id_ends, pa.array(self.ids, pa.int32())).take(self.word)
        flat = words.flatten().to_numpy()
        sizes = np.diff(words.offsets.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])[self.ends]
        return np.split(flat, ends[:-1])

    def spelled(self, tokens: pa.Array) -> list[bytes]:
        """Each chunk's tokens as ``tokens`` writes them."""
        words = pc.binary_join(self._lists(self.id_ends, tokens.take(pa.array(self.ids))), _NOTHING)
        return [t.as_buffer() for t in pc.binary_join(self._lists(self.ends, words.take(self.word)), _NOTHING)]


class Encoder:
    """Words of texts to ids; one per Python worker, which keeps the words it met lately."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.recent = vocabulary, Recent(WORDS)

    def groups(self, texts: list[str]) -> Iterator[Group]:
        """The chunks of all texts in order, so many at a time as make a block."""
        numbers, ends, words, size = [], [], [], 0
        for i, text in enumerate(texts):
            for chunk in chunks(text):
                words += self.vocabulary.words(chunk)
                numbers.append(i)
                ends.append(len(words))
                size += len(chunk)
                if size >= BLOCK:
                    yield self._group(numbers, ends, words)
                    numbers, ends, words, size = [], [], [], 0
        if numbers:
            yield self._group(numbers, ends, words)

    def _group(self, numbers: list[int], ends: list[int], words: list[str]) -> Group:
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = self.recent.missing([distinct])
        known = self.recent.known
        known.update(zip(new, self.vocabulary.encode(new)))
        packed = list(map(known.__getitem__, distinct))
        return Group(numbers, np.array(ends), coded.indices, np.frombuffer(b"".join(packed), "<i4"),
                     np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed))) // 4)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(vocabulary_of(path))


class Digest:
    """Count and hash of texts whose parts come one after another, a blank before each token."""

    def __init__(self):
        self.n, self.hash = 0, hashlib.sha256()

    def add(self, spelled: bytes) -> None:
        self.hash.update(memoryview(spelled)[0 if self.n else 1:])
        self.n += len(spelled)


def _texts(part: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in part.column("_text").to_pylist()]


def _source(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, str]:
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("_doc"), F.col(text).cast("string").alias("_text"))
    return source, source.schema["_doc"].dataType.simpleString()


def encode(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(id, ids): the token ids of each row's whole text, as the tokenizer gives them.

    Null, empty and blank texts have no ids. Strings of special tokens are those tokens. One row per
    row, repeated and null ids too; other columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text", BLOCK):
            ids = [[] for _ in range(part.num_rows)]
            for group in _encoder(path).groups(_texts(part)):
                for i, found in zip(group.text, group.ids_of_chunks()):
                    ids[i].append(found)
            rows = [np.concatenate(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), pa.array(rows, pa.list_(pa.int32()))], ["_doc", "ids"])

    source, kind = _source(docs, id_col, text)
    return source.mapInArrow(run, f"_doc {kind}, ids array<int>").withColumnRenamed("_doc", id_col)


def decode(encoded: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): tokens joined by blanks; null for null ids, unknown ids are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary_of(path).tokens
        for part in batches:
            out = [None if ids is None else " ".join(tokens[i] for i in ids if i in tokens)
                   for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), part.column("ids"), pa.array(out, pa.string())],
                ["_doc", "ids", "decoded"])

    source = encoded.select(F.col(id_col).alias("_doc"), "ids")
    kind = source.schema["_doc"].dataType.simpleString()
    return source.mapInArrow(run, f"_doc {kind}, ids array<int>, decoded string").withColumnRenamed(
        "_doc", id_col)


def round_trip(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id",
               text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): ids and decoded text of each row, hashed.

    The same as ``decode(encode(docs))``, in one pass that holds a block of text and its words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spellings = vocabulary_of(path).spellings()
        for part in blocks(batches, "_text", BLOCK):
            counts = np.zeros(part.num_rows, np.int64)
            hashes = [[Digest() for _ in range(part.num_rows)] for _ in spellings]
            for group in _encoder(path).groups(_texts(part)):
                np.add.at(counts, group.text, [len(i) for i in group.ids_of_chunks()])
                for digests, tokens in zip(hashes, spellings):
                    for i, spelled in zip(group.text, group.spelled(tokens)):
                        digests[i].add(spelled)
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc"), pa.array(counts),
                 *[pa.array([d.hash.hexdigest() for d in digests]) for digests in hashes]],
                ["_doc", "n_tokens", "ids_sha256", "decoded_sha256"])

    source, kind = _source(docs, id_col, text)
    return source.mapInArrow(
        run, f"_doc {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    ).withColumnRenamed("_doc", id_col)
