"""Each operator on odd input, and against brute force where SQL has no twin."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib
from dataclasses import replace

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from llm_help import by_id
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import (
    bpe, exact_dedup, license_scan, ngram_lm, packing, queries, simhash, substring, token_rollup,
    topk, toxicity,
)
from tidemark.llm.elias_fano import EliasFano

ODD = ["", None, " \n\t", "One two", "one TWO", "ÄÖ é x", "a " * 3000, "x", "x"]


# 1: top-k search

VECTORS = "vec_id long, embedding array<float>"


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    vectors += [(120 + i, vectors[0][1]) for i in range(8)]  # ties
    got = topk.top_k(spark.createDataFrame(vectors, VECTORS), F.col("vec_id") % 50 == 0, k=5)
    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors}
    expected = set()
    for q in (0, 50, 100):
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], v)), i)
                        for i, v in whole.items() if i != q)[:5]
        expected |= {(q, n, i, -s) for n, (s, i) in enumerate(ranked, 1)}
    assert set(map(tuple, got.collect())) == expected


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = spark.createDataFrame(
        [(0, [1.0, 2.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]),
         (None, [9.0, 9.0]), (5, [1.0]), (6, []), (7, [-1.0, 0.0]), (7, [-1.0, 0.0])], VECTORS)
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == [
        (0, 1, 5, 65536), (0, 2, 6, 0), (0, 3, 7, -65536)]
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def _best_of(vectors, queries, k=5):
    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors}
    out = set()
    for q in queries:
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], v)), i)
                        for i, v in whole.items() if i != q)[:k]
        out |= {(q, n, i, -s if abs(s) < 2 ** 63 else None) for n, (s, i) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("size", [1.0, 1e10, 8e12])
def test_top_k_of_copies_and_large_components(spark, size):
    rng = np.random.default_rng(int(size) % 97)
    vectors = [(i, (size * rng.normal(size=5)).tolist()) for i in range(150)]
    vectors += [(150 + i, vectors[i % 3][1]) for i in range(151)]  # queries among the copies
    vectors += [(400 + i, [x + i / 256 for x in vectors[7][1]]) for i in range(5)]  # nearly tied
    kind = "vec_id long, embedding array<double>"
    frame = spark.createDataFrame([*vectors, (500, [1e300] * 5), (501, [4e13] + [0.0] * 4)], kind)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0)
    assert set(map(tuple, got.collect())) == _best_of(vectors, [*range(0, 301, 50), 400])


def test_top_k_broadcasts_no_vectors(spark):
    rng = np.random.default_rng(5)
    frame = spark.createDataFrame(
        [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)], VECTORS)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    joins = re.findall(r"(\w+Join) \[(\w+)#.*?, (Inner|LeftSemi|LeftOuter)", plan)
    # Blocks, candidates and members; of queries the vectors are broadcast, as their bytes are counted.
    merged = [key for kind, key, how in joins if kind == "SortMergeJoin" and how == "Inner"]
    assert sorted(merged) == ["block", "block", "point", "vec_id", "vec_id"]
    assert sorted(key for kind, key, how in joins if kind == "BroadcastHashJoin" and how == "Inner") == [
        "point", "query_id", "query_id"]


def test_top_k_of_one_vector_alone(spark):
    frame = spark.createDataFrame([(i, [1.0]) for i in range(0, 400, 2)], VECTORS)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, k=2)
    assert set(map(tuple, got.collect())) == {
        (q, n, i, 65536) for q in range(0, 400, 50)
        for n, i in enumerate([i for i in (0, 2, 4) if i != q][:2], 1)}


# 2: LM scoring

@pytest.mark.parametrize("high", [1, 10, 10 ** 6, 2 ** 62])
def test_elias_fano(high):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 777):
        values = np.sort(rng.integers(0, high, n)).astype(np.uint64)
        coded = EliasFano.build(values)
        assert (coded.get(np.arange(n)) == values).all()
        asked = np.concatenate([values, values + np.uint64(1), rng.integers(0, high + 5, 50)]).astype(
            np.uint64)
        assert (coded.successor(asked) == np.searchsorted(values, asked)).all()


def test_scores_against_counts(docs):
    random.seed(2)
    texts = [" ".join(random.choices(["a", "B", "b", "c", "dd"], k=random.randrange(60))) for _ in range(60)]
    texts += ["", None, "never seen words", "a b"]
    frame = docs(*texts)
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    got = by_id(ngram_lm.score(frame, held), "held_out", "n_tokens", "n_known", "train_tokens",
                "base_score", "score")
    words, pairs, told = collections.Counter(), collections.Counter(), {}
    for i, t in enumerate(texts, 1):
        told[i] = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + ["\n"]
        if zlib.crc32(str(i).encode()) % 10:
            words.update(told[i])
            words["^"] += 1
            pairs.update(zip(["^", *told[i]], told[i]))
    total, kinds = sum(words.values()) - words["^"], len(words) - 1
    for i, tokens in told.items():
        single = [(words[w] + 0.1) / (total + 0.1 * (kinds + 1)) for w in tokens]
        both = [(pairs[u, w] + 2 * p) / (words[u] + 2)
                for u, w, p in zip(["^", *tokens], tokens, single)]
        out = got[i]
        assert out[:4] == (zlib.crc32(str(i).encode()) % 10 == 0, len(tokens),
                           sum(words[w] > 0 for w in tokens), total)
        assert math.isclose(out[4], sum(map(math.log10, single)), rel_tol=1e-9)
        assert abs(out[5] - sum(map(math.log10, both))) < 0.02 * len(tokens)  # eight bits
    assert ngram_lm.score(frame.limit(0), held).count() == 0


def test_no_text_is_likelier_than_certain(docs):
    got = by_id(ngram_lm.score(docs(*["a"] * 1000), F.lit(False)), "score")
    assert all(-0.1 < s <= 0 for s, in got.values())


# 3: toxicity

def test_toxic_words_are_learned_in_any_spelling(docs, spark):
    random.seed(4)
    calm = ["".join(random.choices("bcdfgmnprt", k=6)) for _ in range(400)]
    texts, labels = [], []
    for i in range(400):
        words = random.choices(calm, k=30)
        if i % 4 == 0:
            words[random.randrange(30)] = "moron"
        elif i % 10 == 1:
            words[4:6] = ["moron", "river"]  # harmless there
        texts.append(" ".join(words))
        labels.append((i + 1, int(i % 4 == 0)))
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs(*texts), given)
    asked = docs("you MORON there", "you m0r0n", "you mоrоn", "a moron river",
                 "calm words", "", None, " ", toxicity="7")
    got = by_id(toxicity.score(asked, model), "toxicity")
    assert [got[i][0] >= 0.5 for i in range(1, 9)] == [True, True, True, False, *[False] * 4]
    assert all(0 <= s <= 1 for (s,) in got.values())
    assert toxicity.learn(docs(*texts), given.limit(0)) == toxicity.Model()
    assert toxicity.score(asked.limit(0), model).count() == 0


@pytest.mark.parametrize("share", [0.4, 0.5, 0.8])
def test_toxic_words_are_learned_from_mostly_toxic_labels(docs, spark, share):
    random.seed(4)
    calm = ["".join(random.choices("bcdfgmnprt", k=6)) for _ in range(400)]
    texts, labels = [], []
    for i in range(600):
        words = random.choices(calm, k=30)
        toxic = i % 10 < 10 * share
        if toxic or i % 20 == 19:  # in some clean texts as well
            words[random.randrange(30)] = "moron"
        texts.append(" ".join(words))
        labels.append((i + 1, int(toxic)))
    model = toxicity.learn(docs(*texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    asked = docs("you MORON there", "you m0r0n", "calm words", texts[8].replace("moron", "calm"), "", None)
    got = by_id(toxicity.score(asked, model), "toxicity")
    assert [got[i][0] >= 0.5 for i in range(1, 7)] == [True, True, *[False] * 4]


def test_labels_that_tell_nothing_drop_nothing(docs, spark):
    texts = [f"one text w{i}" for i in range(40)]
    given = spark.createDataFrame([(i + 1, int(i % 4 > 0)) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.learn(docs(*texts), given)
    assert all(s < 0.5 for (s,) in by_id(toxicity.score(docs(*texts), model), "toxicity").values())


# 4: packing

def test_pieces_are_all_ids_and_fill_their_sequences(docs):
    random.seed(5)
    texts = ODD + ["a<|endoftext|> b", *(" ".join(random.choices(["the", "Thntblere", "é", "12"], k=n))
                                        for n in (5, 700, 1024, 3000, 6000))]
    pieces = packing.pack(docs(*texts)).collect()
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    for i, t in enumerate(texts, 1):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert b"".join(p["ids"] for p in own) == ids.tobytes()
        assert [p["start"] for p in own] == [0, *itertools.accumulate(p["length"] for p in own)][:-1]
        assert all(p["ids_crc32"] == zlib.crc32(p["ids"]) and p["doc_tokens"] == len(ids) for p in own)
    padding = 0
    for _, held in itertools.groupby(sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])),
                                     key=lambda p: p["sequence_id"]):
        held = list(held)
        sizes = [p["length"] for p in held]
        assert [p["offset"] for p in held] == [0, *itertools.accumulate(sizes)][:-1]
        assert sum(sizes) <= 1024
        padding += 0 if sum(sizes).bit_count() == 1 else 1024 - sum(sizes)
    assert padding < 0.02 * sum(p["length"] for p in pieces)
    assert packing.pack(docs("x").limit(0)).count() == 0


@pytest.mark.parametrize("run", [" ", "\n", "\u3000"])
def test_long_blank_runs_have_the_tokenizers_ids(run):
    text = "a b" + run * 2_000_000 + "c"
    ids = Tokenizer.from_file(packing.TOKENIZER).encode(text, add_special_tokens=False).ids
    assert packing.encoder(packing.TOKENIZER)(text) == np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("capacity", [16, 1024])
def test_cuts_fill_their_class(capacity):
    packer = packing.Packer(capacity, 0)
    whole = set()
    for n in range(1, capacity + 1):
        size = packer._cut(n)
        k = capacity // size
        assert 0 < size <= n
        assert capacity - k * size <= max(capacity // packing.SPARE, k)
        if size == n:
            whole.add(k)
    assert whole == {capacity // n for n in range(1, capacity + 1)}
    assert packer._cut(capacity + 1) == capacity


# 5: licence scans

def test_notices_are_found_and_other_text_is_not(docs):
    random.seed(6)
    calm = ["".join(random.choices("abcdefgh", k=5)) for _ in range(200)]
    plain = [" ".join(random.choices(calm, k=25)) for _ in range(60)]
    texts = [*plain, plain[0] + "\nReleased under the MIT License.\n" + plain[1],
             "Licensed under the Apache License, Version 2.0.\nReleased under the MIT license",
             "The driver lost the license.", "", None, "\n\n"]
    frame = docs(*texts, licenses="1")
    got = by_id(license_scan.license_report(frame, license_scan.train(frame)), "licenses", "n_notices")
    assert {i for i, (f, _) in got.items() if f} == {61, 62}
    assert got[61] == ("MIT", 1) and got[62] == ("Apache-2.0, MIT", 2)


GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software "
         "and associated documentation files (the \"Software\"), to deal\nin the Software without "
         "restriction, including without limitation the rights\nto use, copy, modify, merge, publish, "
         "distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the "
         "Software is\nfurnished to do so, subject to the following conditions:")
GPL = (" * This program is free software: you can redistribute it and/or modify\n * it under the terms of the "
       "GNU General Public License as published by\n * the Free Software Foundation, either version {} of the "
       "License, or\n * (at your option) any later version.")
REAL = [
    (GRANT, "MIT"), (GRANT.replace("\n", " "), "MIT"), (GPL.format(3), "GPL-3.0"), (GPL.format(2), "GPL-2.0"),
    (GPL.format(3).replace("General", "Lesser General"), "LGPL-3.0"),
    ("Copyright (c) 2021 Jane Doe. Released under the MIT License.", "MIT"),
    ("The parser was written for a course and has been used in three more since then, with thanks to "
     "all who helped. Released under the MIT License.", "MIT"),
    ("Distributed under the MIT License. See LICENSE for more information.", "MIT"),
    ("// SPDX-License-Identifier: MIT", "MIT"),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 License.", "CC-BY-SA-3.0"),
    ("Licensed under the Apache License, Version 1.1.", None), ("The driver lost the license.", None),
]


def test_real_notices_are_told_apart(docs):
    random.seed(7)
    calm = ["".join(random.choices("abcdefgh", k=5)) for _ in range(200)]
    plain = [" ".join(random.choices(calm, k=25)) for _ in range(60)]
    frame = docs(*[t for t, _ in REAL], *plain)
    model = license_scan.train(frame)
    got = by_id(license_scan.license_report(frame, model), "licenses")
    assert [got[i][0] for i in range(1, len(REAL) + 1)] == [f for _, f in REAL]
    assert all(got[i] == (None,) for i in range(len(REAL) + 1, len(REAL) + 61))

    # What the classifier refuses does not stand, however much of a notice is there.
    refusing = replace(model, least=1.1)
    none = by_id(license_scan.license_report(frame, refusing), "licenses", "n_unknown")
    assert all(none[i] == (None, 1) for i in range(1, len(REAL) + 1))

    # What is confirmed holds half of the word pairs of a notice, counted in Python.
    def pairs(text):
        found = [w.strip(".") for w in re.findall("[a-z0-9.]+", text.lower()) if w.strip(".")]
        return set(zip(found, found[1:]))

    rows = license_scan.scan(frame, model).filter("similarity IS NOT NULL").collect()
    assert len(rows) == sum(f is not None for _, f in REAL)
    for row in rows:
        text = pairs(REAL[row.doc_id - 1][0])
        share = max(len(pairs(n) & text) / len(pairs(n)) for n in license_scan.NOTICES[row.family])
        assert row.similarity == pytest.approx(share) and share >= license_scan.ALIKE


def test_notices_are_found_where_all_texts_have_one(docs):
    frame = docs(*[f"{t}\n\nint f{i}(int x);" for i in range(12) for t, _ in REAL[:10]])
    got = by_id(license_scan.license_report(frame, license_scan.train(frame)), "licenses", "n_notices")
    assert [got[i] for i in range(1, 121)] == [(f, 1) for _ in range(12) for _, f in REAL[:10]]


def test_signs_stand_in_every_notice():
    for family, notices in license_scan.NOTICES.items():
        for notice in notices:
            said = " " + " ".join(w.strip(".") for w in re.findall("[a-z0-9.]+", notice.lower())) + " "
            if re.search(license_scan.TELLING[family], said):
                assert re.search(license_scan.SIGNS, notice.lower()), notice


def test_licences_of_odd_input(docs, spark):
    frame = docs("Released under the MIT License.", "x " * 100_000 + "Released under the MIT License.", "", None,
                 _words="'a'", family="'b'")
    model = license_scan.train(frame)
    twice = frame.unionByName(frame.filter("doc_id = 1")).unionByName(
        frame.filter("doc_id = 1").withColumn("doc_id", F.lit(None).cast("bigint")))
    got = sorted(tuple(r) for r in license_scan.license_report(twice, model).select(
        F.coalesce("doc_id", F.lit(-1)), "licenses", "n_notices").collect())
    assert got == [(-1, "MIT", 1), (1, "MIT", 1), (1, "MIT", 1), (2, "MIT", 1), (3, None, 0), (4, None, 0)]
    assert license_scan.license_report(frame.limit(0), model).count() == 0
    assert license_scan.train(frame.limit(0)).least >= license_scan.LEAST


def test_all_scored_stretches_are_learned_or_kept(docs, monkeypatch):
    """However few paragraphs are drawn to set notices into."""
    for name in ("DRAWN", "SAMPLE"):
        monkeypatch.setattr(license_scan, name, 2, raising=False)
    seen, fit = [], license_scan.LogisticRegression.fit

    def counted(self, rows, *args):
        seen.append(rows.filter("label = 0").count())
        return fit(self, rows, *args)

    monkeypatch.setattr(license_scan.LogisticRegression, "fit", counted)
    texts = [f"The office of town {i} sent driver {7 * i} a license." for i in range(300)]
    model = license_scan.train(docs(*texts, *texts, *["none"] * 9))
    # A half of the 300 by hash, as they are and their first words; copies count once.
    others = 2 * 2 * 2 + license_scan.COPIES * len(license_scan.OTHER)
    assert 200 < seen[0] - others < 400
    found = by_id(license_scan.license_report(docs(*texts), model), "licenses", "n_unknown")
    assert set(found.values()) == {(None, 1)}


def test_no_notice_is_longer_than_a_step():
    assert all(len(re.findall("[A-Za-z0-9.]+", t)) <= license_scan.STEP
               for ts in license_scan.NOTICES.values() for t in ts)


# 6: token counts

def test_batches_count_once(docs, spark, tmp_path):
    path = str(tmp_path / "totals")
    rows = token_rollup.counted(docs("a b", "c", None), {
        "words-1": token_rollup.word_count(F.col("text"))})
    for batch in ("first", "first"):
        token_rollup.commit(token_rollup.inserts(rows), path, batch)
    revised = rows.filter("doc_id = 2").withColumn("more", F.lit(10))
    token_rollup.commit(token_rollup.revisions(revised, "tokens", "more"), path, "second")
    token_rollup.commit(token_rollup.deletes(rows.filter("doc_id = 1")), path, "third")
    assert [tuple(r) for r in token_rollup.totals(spark, path).collect()] == [
        ("s", "en", "words-1", 2, 10)]


# 7: exact dedup

def test_token_counts_of_rows_without_an_id(docs, spark, tmp_path):
    frame = docs((None, "a b c"), (None, None), (1, "d e"), (2, "f"), (2, "f"), (3, ""))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (None, 0), (2, 1)], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet")
    db = duckdb.connect()
    for table in ("documents", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = queries.op6_token_counts(spark, str(tmp_path))
    expected = db.execute("SELECT source, lang, tokenizer, docs, tokens FROM ("
                          + queries.ORACLES["op6_token_counts"] + ")").fetchall()
    assert sorted(map(tuple, got.select("source", "lang", "tokenizer", "docs", "tokens").collect())) \
        == sorted(expected) == [("s", "en", "bytes-1", 5, 7), ("s", "en", "words-1", 5, 5)]


@pytest.mark.parametrize("ids", [exact_dedup.chunk_ids, lambda c: [F.length(c).cast("bigint")]])
def test_equal_texts_whatever_the_identifiers(docs, ids):
    """The second identifier is the same for different chunks, which their contents tell apart."""
    long = "".join(f"sentence {i}. " for i in range(900))
    texts = [*ODD, long, long.upper(), long + "x", "y"]
    got = by_id(exact_dedup.duplicate_groups(docs(*texts), ids=ids), "keep_id", "group_size", "kept",
                "text_sha256")
    lower = {i: "".join(c.lower() if c.isascii() else c for c in t or "") for i, t in enumerate(texts, 1)}
    for i, t in lower.items():
        same = [j for j, u in lower.items() if u == t]
        assert got[i] == (max(same), len(same), i == max(same), hashlib.sha256(t.encode()).hexdigest())


def test_one_of_repeated_rows_stays(docs):
    frame = docs((1, "a"), (1, "A"), (1, "b"), (None, "c"), (None, "c"), (2, "c"), (None, "d"), kept="5")
    left = exact_dedup.drop_duplicates(frame)
    assert left.columns == frame.columns
    assert sorted(((r["doc_id"] or 0, r["text"].lower()) for r in left.collect())) == [
        (0, "d"), (1, "a"), (1, "b"), (2, "c")]
    assert exact_dedup.drop_duplicates(frame.limit(0)).count() == 0


# 8: SimHash near-dedup

def _fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_against_brute_force(docs):
    random.seed(8)
    base = [random.choice("abcdefghij") * 3 + str(i) for i in range(300)]
    texts = [*ODD]
    for n in range(60):  # near copies in a chain
        base[random.randrange(300)] = f"new{n}"
        texts.append(" ".join(base))
    frame = docs(*texts, component_id="0")
    prints = {i: _fingerprint(t) for i, t in enumerate(texts, 1)}
    root = {i: i for i in prints}
    for _ in prints:
        for i, j in itertools.combinations(prints, 2):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[i] = root[j] = min(root[i], root[j])
    got = by_id(simhash.near_duplicate_groups(frame), "fingerprint", "component_id")
    assert got == {i: (f"{prints[i]:016x}", root[i]) for i in prints}
    left = simhash.drop_near_duplicates(frame)
    assert left.columns == frame.columns
    assert {r["doc_id"] for r in left.collect()} == set(root.values())
    assert simhash.near_duplicate_groups(frame.limit(0)).count() == 0


def _close(points, radius):
    """All pairs within the radius, and the smallest fingerprint reachable from each."""
    values = np.array(points, np.int64)
    near = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= radius
    root = values.copy()
    while True:
        low = np.where(near, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (low == root).all():
            return near, dict(zip(points, root.tolist()))
        root = low


def _crowded():
    """Fingerprints of a few crowded places, so that buckets are dealt on, and some strangers."""
    rng = random.Random(18)
    points = {rng.getrandbits(64) for _ in range(300)}
    for centre in [0, *(rng.getrandbits(64) for _ in range(2))]:
        low = rng.sample(range(64), 14)
        points |= {centre ^ sum(1 << b for b in low if rng.random() < 0.4) for _ in range(900)}
    return sorted(simhash._signed(p) for p in points)


@pytest.mark.parametrize("radius, bucket", [(2, 256), (2, 2), (1, 2), (3, 4096)])
def test_links_of_crowded_buckets_against_brute_force(spark, monkeypatch, radius, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    points = _crowded()
    frame = spark.createDataFrame([(p,) for p in points], "fp long")
    near, root = _close(points, radius)
    place = {p: i for i, p in enumerate(points)}
    found = [tuple(r) for r in simhash.links(frame, radius).collect()]
    assert all(near[place[a], place[b]] for a, b in found)
    assert len(found) == len(set(found))
    got = dict(root)
    if found:
        nodes = simhash.components(spark.createDataFrame(found, "a long, b long"))
        got = {p: p for p in points} | {r["node"]: r["root"] for r in nodes.collect()}
    assert got == root


def test_every_table_finds_pairs_of_its_own(spark, monkeypatch):
    pairs = [(0, 1 << i | 1 << j) for i, j in itertools.combinations(range(7), 2)]
    whole = simhash.masks(2)
    for gone in range(len(whole)):
        monkeypatch.setattr(simhash, "masks", lambda radius, seen=0: whole[:gone] + whole[gone + 1:])
        lost = [p for p in pairs if not any(p[0] & m == p[1] & m for m in simhash.masks(2))]
        assert lost
        # Far from one another, so that no third fingerprint joins the two.
        frame = spark.createDataFrame([(p,) for p in lost[0]], "fp long")
        assert simhash.links(frame, 2).count() == 0
    monkeypatch.undo()
    assert simhash.links(frame, 2).count() == 1


def test_masks_cover_all_pairs_of_bits():
    for seen in (0, *simhash.masks(2)):
        tables = simhash.masks(2, seen)
        assert all(m & seen == seen for m in tables)
        free = [i for i in range(64) if not seen >> i & 1]
        for i, j in itertools.combinations_with_replacement(free, 2):
            assert any(not m >> i & 1 and not m >> j & 1 for m in tables)
        if seen:
            assert all(64 - m.bit_count() <= simhash.FREE for m in tables)


def test_links_of_a_bucket_are_a_forest():
    members = np.array(_crowded(), np.int64)
    near, root = _close(members.tolist(), 2)
    a, b = simhash._forest(members.view(np.uint64), 2)
    assert sum(map(len, a)) == len(members) - len(set(root.values()))


# 9: substring dedup

@pytest.mark.parametrize("max_bits", [28, 4])  # with four bits the sketch lets all windows through
def test_passages_against_brute_force(docs, max_bits):
    random.seed(9)
    words = [f"w{i}" for i in range(50)]
    passage = " ".join(random.choices(words, k=40))
    texts = [*ODD] + [" \n".join([" ".join(random.choices(words, k=20)), passage, "end"]) for _ in range(12)]
    texts += [passage.replace(" ", "\t"), passage.upper(), passage]
    first, told = {}, {}
    for i, t in enumerate(texts, 1):
        told[i] = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(told[i]) - 12):
            first.setdefault(tuple(told[i][k:k + 13]), i)
    got = by_id(substring.remove_repeats(docs(*texts, n_words="1"), max_bits=max_bits),
                "kept_text", "n_words", "n_removed")
    for i, own in told.items():
        gone = {p for k in range(len(own) - 12) if first[tuple(own[k:k + 13])] < i
                for p in range(k, k + 13)}
        kept = " ".join(w for p, w in enumerate(own) if p not in gone)
        assert got[i] == (kept, len(own), len(gone))


def test_only_smaller_ids_remove(docs):
    passage = " ".join(f"w{i}" for i in range(20))
    frame = docs((5, passage), (5, passage), (None, passage), (3, "x " + passage), kept_text="'own'")
    left = substring.without_repeats(frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"], r["n_chars"], r["kept_text"]) for r in left.collect()) == [
        (0, passage, len(passage), "own"), (3, "x " + passage, len(passage) + 2, "own"),
        (5, "", 0, "own"), (5, "", 0, "own")]
    assert substring.without_repeats(frame.limit(0)).count() == 0


def test_spans_of_copies_spread_over_the_shards(docs):
    text = " ".join(f"w{i}" for i in range(40))
    frame = docs(*[text] * 200).selectExpr("doc_id AS _doc", "xxhash64(text) AS _content", "text AS _text")
    settled = substring.dealt_windows(frame.coalesce(1)).filter("docs IS NULL")
    sizes = [r["count"] for r in settled.groupBy("shard").count().collect()]
    assert sum(sizes) == 199 and len(sizes) == 8 and max(sizes) < 80
    got = by_id(substring.remove_repeats(docs(*[text] * 200)), "n_removed")
    assert [got[i][0] for i in range(1, 201)] == [0] + [40] * 199


# 10: BPE

def _library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.merges_of(bpe.RANKS).ranks)


def test_ids_and_bytes_as_the_library_has_them(docs):
    random.seed(10)
    texts = ODD + ["<|endoftext|>", "it's  two\n\n x", "日本語 текст ßü\U0001f600"]
    texts += ["".join(random.choices("abct hier's\n é12", k=400)) for _ in range(40)]
    done = bpe.digests(bpe.decode(bpe.encode(docs(*texts, ids="1"))))
    got = by_id(done, "n_tokens", "ids_sha256", "decoded_sha256")
    for i, t in enumerate(texts, 1):
        ids = _library().encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256((t or "").encode()).hexdigest())
    assert by_id(bpe.round_trip(docs(*texts, ids="1")), "n_tokens", "ids_sha256",
                 "decoded_sha256") == got
    assert bpe.encode(docs("x").limit(0)).count() == 0
    assert bpe.round_trip(docs("x").limit(0)).count() == 0


def test_merges_that_come_due_at_once():
    """A merge may make a pair of a lower rank than its own; it goes before the rest of the word."""
    random.seed(11)
    for _ in range(300):
        made = {bytes([b]): b for b in range(256)}
        while len(made) < 275:
            a, b = random.choices([t for t in made if t.strip(b"abc") == b""], k=2)
            made.setdefault(a + b, 0)
        order = [t for t in made if len(t) > 1]
        random.shuffle(order)
        ranks = {t: i for t, i in made.items() if len(t) == 1} | {t: 256 + i for i, t in enumerate(order)}
        library = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(random.choices("abc", k=random.randrange(1, 14))) for _ in range(20)]
        assert bpe.Merges(ranks).replay([w.encode() for w in words]) == [
            library.encode_ordinary(w) for w in words]
