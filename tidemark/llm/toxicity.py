"""Toxicity by a weighted lexicon, learned from labels and matched by Aho-Corasick.

Texts are folded first: lookalike letters of other scripts, digits and signs that stand for
letters, and case come to one form, in which l and i are one letter as 1 may mean either. The
lexicon holds words and word beginnings that label 1 favours beyond chance, each weighted by its
log odds. Phrases of a lexicon word and its neighbour that label 0 favours are exceptions: what
they cover does not count. A text's score is a logistic function of its matched weight, as a sum
and divided by the root of its length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import blocks, small_batches, stored

SAMPLE = 20_000  # labelled texts the model is learned from, at most
LEXICON = 5_000  # entries, at most
LEAST = 4  # letters of a word beginning, at least
LONGEST = 24
CHANCE = 1e-7  # how unlikely an entry's toxic share must be under the overall share

# Letters of other scripts that look like Latin ones, in pairs.
HOMOGLYPHS = ("аa еe оo рp сc уy хx іi јj ѕs ԁd ԛq ԝw һh ӏl вb кk мm нh тt гr пn "
              "αa βb εe ηn ιi κk νv οo ρp τt υu χx ωw ıi ɡg ɑa ʟl ʀr ƅb ɩi")
# Digits and signs that stand for letters inside a word.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "+": "t"}
_HIDDEN = dict.fromkeys([0xAD, 0x34F, 0x2060, 0xFEFF, *range(0x200B, 0x2010)])
_TABLE = {ord(p[0]): p[1] for p in HOMOGLYPHS.split()} | _HIDDEN | {ord("l"): "i"}
_IN_WORD = re.compile(r"(?<=[^\W\d_])[01345789@$€]+|[01345789@$€]+(?=[^\W\d_])"
                      r"|(?<=[^\W\d_])[!|+](?=[^\W\d_])")
_APART = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """One form of all spellings: words of folded letters, each between single blanks."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower().translate(_TABLE)
    text = _IN_WORD.sub(lambda m: "".join(SIGNS.get(c, c) for c in m.group()), text)
    return f" {_APART.sub(' ', text).strip()} "


@dataclass(frozen=True)
class Model:
    """Folded entries with a blank before and, for whole words, behind; and the score's line."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    line: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def key(self) -> tuple:
        return tuple(sorted(self.weights.items())), self.exceptions, self.line


@lru_cache(maxsize=2)
def _automaton(key: tuple) -> ahocorasick.Automaton | None:
    weights, exceptions, _ = key
    if not weights:
        return None
    found = ahocorasick.Automaton()
    for entry, weight in weights:
        found.add_word(entry, (entry, weight))
    for phrase in exceptions:
        found.add_word(phrase, (phrase, None))
    found.make_automaton()
    return found


def matches(folded: str, automaton: ahocorasick.Automaton | None) -> list[tuple[int, str, float]]:
    """(end, entry, weight) of what counts: no match inside an exception phrase, and of matches
    that begin at one word the longest alone."""
    if automaton is None:
        return []
    spans = [(end - len(e) + 1, end, e, w) for end, (e, w) in automaton.iter(folded)]
    if not spans:
        return []
    covered = [(a, b) for a, b, _, w in spans if w is None]
    best: dict[int, tuple[int, str, float]] = {}
    for a, b, e, w in spans:
        if w is None or any(x <= a and b <= y for x, y in covered):
            continue
        if a not in best or best[a][0] < b:
            best[a] = (b, e, w)
    return [best[a] for a in sorted(best)]


def _features(folded: str, automaton: ahocorasick.Automaton | None) -> tuple[float, float]:
    total = sum(w for _, _, w in matches(folded, automaton))
    words = folded.count(" ") - 1 if folded.strip() else 0
    return math.log1p(total), total / math.sqrt(words + 1)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def _entries(folded: str) -> set[str]:
    """A text's words and word beginnings as entries."""
    out = set()
    for word in set(folded.split()):
        if len(word) <= LONGEST and not word.isdigit():
            out.add(f" {word} ")
            out.update(f" {word[:n]}" for n in range(LEAST, len(word) + 1))
    return out


def _smallest_shingle(folded: str) -> int:
    words = folded.split()
    return min((xxhash.xxh64_intdigest(" ".join(words[i:i + 5])) >> 1
                for i in range(max(len(words) - 4, 1))), default=0)


def _choose(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries that label 1 favours beyond chance: neither one that a longer entry says as well,
    nor one that begins with another."""
    share = toxic / (toxic + clean)
    good = {}
    for entry, t, c in counts:
        p, q = share, t / (t + c)
        if q <= p:
            continue
        # Chernoff's bound of so high a toxic share of t + c texts
        rest = (1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0.0
        if -(t + c) * (q * math.log(q / p) + rest) < math.log(CHANCE):
            weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
            if weight > 1:
                good[entry] = (t, weight)
    said = set()
    for entry, (t, _) in good.items():
        shorter = entry.rstrip(" ") if entry.endswith(" ") else entry[:-1]
        if shorter in good and t >= 0.9 * good[shorter][0]:
            said.add(shorter)
    # Of an entry and one that begins with it the longer stays where it is clearly stronger.
    kept: dict[str, float] = {}
    for entry in sorted(set(good) - said, key=len, reverse=True):
        weight = good[entry][1]
        longer = [e for e in kept if e.startswith(entry)]
        if not longer or max(kept[e] for e in longer) < weight + 1:
            kept = {e: w for e, w in kept.items() if e not in longer} | {entry: weight}
    return dict(sorted(kept.items(), key=lambda e: (-e[1], e[0]))[:LEXICON])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          exceptions: Sequence[str] = (), id_col: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model:
    """A model from labelled texts (label 1 or 0; others are left out).

    At most ``sample`` labelled ids are drawn, by hash of the id. Copies count once: of sampled
    texts that share their smallest shingle hash one is used. Entries are told by odds, whatever
    the share of label 1. Without both labels, or where no entry stands out, the lexicon is empty
    and every score close to 0.
    """
    small_batches(docs.sparkSession)
    drawn = (labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
             .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    told = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(drawn), "_id").select("_label", "_text")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text"):
            texts = [fold(t or "") for t in part.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_label"), pa.array(texts),
                 pa.array([_smallest_shingle(t) for t in texts], pa.int64())],
                ["_label", "_text", "_key"])

    told = (told.mapInArrow(folded, "_label int, _text string, _key bigint")
            .groupBy("_key").agg(F.max(F.struct("_label", "_text")).alias("_one"))
            .select("_one._label", "_one._text"))
    told = stored(told, "labelled-texts")
    sizes = {r["_label"]: r["count"] for r in told.groupBy("_label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    return _learned(told, sizes, exceptions)


def _learned(told: DataFrame, sizes: dict[int, int], exceptions: Sequence[str]) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text", 1 << 20):
            toxic, clean = Counter(), Counter()
            for y, t in zip(part.column("_label").to_pylist(), part.column("_text").to_pylist()):
                (toxic if y else clean).update(_entries(t))
            yield _counted(toxic, clean)

    def _counted(toxic: Counter, clean: Counter) -> pa.RecordBatch:
        names = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()),
             pa.array([clean[n] for n in names], pa.int64())], ["name", "t", "c"])

    def totals(run) -> DataFrame:
        return told.mapInArrow(run, "name string, t bigint, c bigint").groupBy("name").agg(
            F.sum("t").alias("t"), F.sum("c").alias("c"))

    share = sizes[1] / (sizes[0] + sizes[1])
    least = math.ceil(math.log(CHANCE) / math.log(share))  # fewer toxic texts never suffice
    odds = (F.col("t") + 0.5) * (sizes[0] + 1) / ((F.col("c") + 0.5) * (sizes[1] + 1))
    likely = totals(count).filter((F.col("t") >= least) & (odds > math.e))  # as _choose asks
    strongest = likely.orderBy(F.desc("t"), "name").limit(20 * LEXICON)
    weights = _choose([tuple(r) for r in strongest.collect()], sizes[1], sizes[0])
    if not weights:
        return Model()
    bare = Model(weights).key()

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "_text"):
            toxic, clean = Counter(), Counter()
            for y, t in zip(part.column("_label").to_pylist(), part.column("_text").to_pylist()):
                (toxic if y else clean).update({p for m in matches(t, _automaton(bare)) for p in _around(t, m)})
            yield _counted(toxic, clean)

    given = tuple(fold(e) for e in exceptions if fold(e).strip())
    learned = tuple(
        r["name"] for r in totals(phrases).filter("c >= 3 AND c >= 4 * t")
        .orderBy(F.desc("c"), "name").limit(LEXICON).collect())
    model = Model(weights, (*given, *learned))
    rows = told.mapInArrow(_measure(model), "y int, a double, b double").toArrow()
    return Model(weights, model.exceptions, _fit(
        rows["y"].to_numpy(), rows["a"].to_numpy(), rows["b"].to_numpy()))


def _measure(model: Model):
    key = model.key()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _automaton(key)
        for part in blocks(batches, "_text"):
            both = [_features(t, found) for t in part.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("_label"), pa.array([b[0] for b in both], pa.float64()),
                 pa.array([b[1] for b in both], pa.float64())], ["y", "a", "b"])
    return run


def _around(text: str, match: tuple[int, str, float]) -> list[str]:
    """The matched word with the word before it, and with the word behind it."""
    end, entry, _ = match
    start = end - len(entry) + 1
    stop = text.index(" ", start + 1)
    out = []
    if start > 0:
        out.append(text[text.rindex(" ", 0, start):stop + 1])
    if stop + 1 < len(text):
        out.append(text[start:text.index(" ", stop + 1) + 1])
    return out


def _fit(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on the two lengths of matched weight, by Newton's method.

    Where label 1 is the larger one both count alike in all, or its share alone would call texts
    toxic in which nothing matches.
    """
    toxic = y.sum()
    count = np.where(y == 1, min(1.0, (len(y) - toxic) / max(toxic, 1)), 1.0)
    x = np.stack([np.ones(len(y)), a, b], axis=1)
    w = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (count * p * (1 - p))) @ x + ridge, x.T @ (count * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
    w[1:] = np.maximum(w[1:], 0)  # more matched weight never lowers a score
    return tuple(map(float, w))


def score(docs: DataFrame, model: Model, text: str = "text",
          name: str = "toxicity") -> DataFrame:
    """All rows and columns, and the score of the whole text (an existing column is replaced).

    From 0 to 1; null, empty and wordless texts have the score of no match.
    """
    small_batches(docs.sparkSession)
    carried = [c for c in docs.columns if c != name]
    shared = docs.sparkSession.sparkContext.broadcast(model.key())  # bounded by LEXICON

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = shared.value
        found, (base, by_sum, by_length) = _automaton(key), key[2]
        for part in blocks(batches, text):
            scores = []
            for t in part.column(text).to_pylist():
                total, dense = _features(fold(t or ""), found)
                scores.append(_sigmoid(base + by_sum * total + by_length * dense))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in carried], pa.array(scores, pa.float64())],
                [*carried, name])

    return docs.select(*carried).mapInArrow(run, docs.select(*carried).schema.add(name, "double"))
