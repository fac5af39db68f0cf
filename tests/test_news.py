"""News: order, grouping, scoring and the replies of a scorer that misbehaves."""

from __future__ import annotations

import json

import pytest
from helpers import close_to, column, rows
from pyspark.sql import functions as F

from tidemark.functions.text import words
from tidemark.operators import match, news


@pytest.fixture(scope="module")
def items(spark):
    data = [("A", f"t{i:02d}", f"s{i}", f"2026-04-{i + 1:02d} 08:00:00") for i in range(25)]
    data += [("A", "same b", "x", "2026-04-29 08:00:00"), ("A", "same a", "x", "2026-04-29 08:00:00"),
             ("A", "undated", "x", None), ("B", 'say "hi"\n', None, "2026-04-01 00:00:00")]
    return spark.createDataFrame(
        data, "ticker string, title string, summary string, ts string").select(
        "ticker", "title", "summary", F.to_timestamp("ts").alias("publication_date"))


def test_newest_three_settles_ties_by_title(items):
    got = news.neutral_news(items).filter("ticker = 'A'")
    assert column(got, "title") == ["same a", "same b", "t24"]
    assert {r["sentiment_score"] for r in got.collect()} == {0.0}


def test_undated_items_come_last(items):
    few = items.filter("ticker = 'A' and title in ('undated', 't00')")
    assert column(news.newest_news(few, 1), "title") == ["t00"]
    assert column(news.neutral_news(few), "news_date", "title")[1] is None


def test_json_holds_the_newest_twenty(items):
    got = {r["ticker"]: json.loads(r["news_json"]) for r in news.news_to_json(items).collect()}
    assert len(got["A"]) == 20 and got["A"][0]["title"] == "same a"
    assert got["B"][0]["title"] == 'say "hi"\n'


def replies(spark, text):
    return spark.createDataFrame([("A", text)], "ticker string, reply string")


def test_replies(spark):
    reply = json.dumps({"extracted_news": [
        {"title": f"t{i}", "sentiment_score": s, "summary": "why"}
        for i, s in enumerate((7.0, -3.0, 0.25, 0.5))]})
    assert rows(news.parse_replies(replies(spark, reply))) == [
        ("A", "t0", 1.0, "why"), ("A", "t1", -1.0, "why"), ("A", "t2", 0.25, "why")]
    for bad in ("{}", "not json", '{"extracted_news": [], "error": "say "hi""}', None):
        assert news.parse_replies(replies(spark, bad)).count() == 0


def test_scored_news(items):
    def make_scorer():
        import json as j

        def score(payload):
            picked = [{"title": i["title"], "sentiment_score": 0.5, "summary": "up"}
                      for i in j.loads(payload)]
            return j.dumps({"extracted_news": picked})
        return score

    got = news.scored_news(items, make_scorer)
    assert column(got.filter("ticker = 'A'"), "title") == ["same a", "same b", "t24"]
    assert {str(r["news_date"]) for r in got.filter("title = 't24'").collect()} == {"2026-04-25"}


def test_failing_scorer_costs_its_rows_only(spark):
    def make_scorer():
        def score(payload):
            if "bad" in payload:
                raise RuntimeError('no "quota" left')
            return '{"extracted_news": []}'
        return score

    df = spark.createDataFrame([("1", "good"), ("2", "bad"), ("3", ""), ("4", None)],
                               "id string, payload string")
    got = column(df.select("id", news.score_json(make_scorer)("payload").alias("reply")), "reply",
                 "id")
    assert got[0] == '{"extracted_news": []}'
    assert json.loads(got[1]) == {"extracted_news": [], "error": 'no "quota" left'}
    assert got[2:] == ["{}", "{}"]


def test_without_a_scorer_news_is_neutral(items):
    assert rows(news.scored_news(items, None)) == rows(news.neutral_news(items))


def test_attach_dates_takes_the_newest_of_a_title(spark, items):
    picks = spark.createDataFrame([("A", "t03", 0.1, "s"), ("A", "unknown", 0.1, "s")],
                                  "ticker string, title string, sentiment_score double, "
                                  "summary string")
    twice = items.unionByName(items.filter("title = 't03'").withColumn(
        "publication_date", F.to_timestamp(F.lit("2026-05-01"))))
    assert [str(d) for d in column(news.attach_dates(picks, twice), "news_date", "title")] == [
        "2026-05-01", "None"]


def test_retry():
    waits, calls = [], []

    def flaky(text):
        calls.append(text)
        if len(calls) < 3:
            raise OSError("later")
        return "done"

    assert news.with_retry(flaky, sleep=waits.append)("x") == "done"
    assert waits == [2.0, 2.0]

    def broken(text):
        raise OSError("never")

    waits.clear()
    with pytest.raises(OSError):
        news.with_retry(broken, attempts=5, sleep=waits.append)("x")
    assert waits == [2.0, 2.0, 4.0, 8.0]


def test_lexicon(spark):
    df = spark.createDataFrame([("Gain, gain; LOSS",), ("again lossy",), (None,)], "t string")
    got = [r[0] for r in df.select(news.lexicon_score(words("t"), ["gain"], ["loss"])).collect()]
    assert close_to(got[0], 1 / 3) and got[1:] == [0.0, 0.0]


TEXTS = [
    (1, "Shares of PT Bank Utama Raya (Tbk) rose"), (2, "ABCD up 2%"), (3, "abcdX and XABCD"),
    (4, "Bank of Utama Raya"), (5, "PT  BANK utama-raya TBK; abcd"), (6, ""), (7, None),
    (8, "the end: PT Bank Utama Raya Tbk"),
]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_entities_match_whole_words_on_both_paths(spark, limit):
    """With limit 0 the list counts as long and takes the shuffled way."""
    texts = spark.createDataFrame(TEXTS, "doc_id long, text string")
    companies = spark.createDataFrame(
        [("ABCD.ID", "PT Bank Utama Raya Tbk"), ("ZZZZ.ID", "Nobody"), ("..", "")],
        "ticker string, company_name string")
    terms = match.search_terms(companies, suffix=".ID")
    got = match.match_entities(texts, terms, max_terms=limit)
    assert rows(got) == [("ABCD.ID", n) for n in (1, 2, 5, 8)]


def test_entity_paths_agree_with_a_frequent_word(spark):
    texts = spark.createDataFrame(
        [(i, f"common word {'alpha' if i % 3 == 0 else 'beta'} {i % 7}") for i in range(300)],
        "doc_id long, text string")
    companies = spark.createDataFrame(
        [(str(k), f"alpha {k}") for k in range(7)] + [("beta", "common")],
        "ticker string, company_name string")
    terms = match.search_terms(companies)
    short = match.match_entities(texts, terms)
    long = match.match_entities(texts, terms, max_terms=0)

    def said(text, term):
        return f" {term} " in f" {text} "

    expected = sorted({(k, i) for i, t in [(r[0], r[1]) for r in texts.collect()]
                       for k, n in [(r[0], r[1]) for r in companies.collect()]
                       if said(t, k) or said(t, n)})
    assert rows(short) == rows(long) == expected


@pytest.mark.parametrize("max_terms", [0, 1000])
def test_entities_match_their_own_texts(spark, max_terms):
    texts = spark.createDataFrame(
        [(1, "blue whale"), (1, "red fox"), (None, "blue whale"), (2, "a blue whale swims")],
        "doc_id long, text string")
    entities = spark.createDataFrame([("X", "Blue Whale"), ("Z", "fox")],
                                     "ticker string, company_name string")
    found = match.match_entities(texts, match.search_terms(entities), keep=["text"],
                                 max_terms=max_terms)
    assert set(map(tuple, found.collect())) == {
        ("X", 1, "blue whale"), ("X", None, "blue whale"), ("X", 2, "a blue whale swims"),
        ("Z", 1, "red fox")}
    assert found.count() == 4


@pytest.mark.parametrize("max_terms", [10, 0])
def test_a_long_common_word_makes_no_candidates(spark, max_terms):
    """All names and texts share the longest word; only texts with the rare one are searched."""
    shared = "internationalcorporation"
    texts = spark.createDataFrame(
        [(i, f"{shared} w{i % 50} and {shared} {'' if i % 2 else 'x'} w{i % 10}") for i in range(400)],
        "doc_id long, text string")
    names = [(str(k), f"{shared} W{k}") for k in range(8)] + [("unseen", f"{shared} zzz")]
    terms = match.search_terms(spark.createDataFrame(names, "ticker string, company_name string"))
    tried = match.candidates(texts, terms, max_terms=max_terms).filter(
        F.col("phrase") != F.col("anchor")).select("ticker", "doc_id")
    having = {(str(k), i) for i in range(400) for k in range(8) if k in (i % 50, i % 10)}
    assert sorted(map(tuple, tried.collect())) == sorted(having)
    found = match.match_entities(texts, terms, max_terms=max_terms)
    # What follows the shared word directly is w{i % 50}, or w{i % 10} where no x stands between.
    assert sorted(map(tuple, found.select("ticker", "doc_id").collect())) == sorted(
        (k, i) for k, i in having if int(k) == i % 50 or (i % 2 and int(k) == i % 10))


def test_heavy_words_are_salted(spark, monkeypatch):
    monkeypatch.setattr(match, "HEAVY_USES", 20)
    monkeypatch.setattr(match, "HEAVY_WORDS", 1000)
    texts = spark.createDataFrame([(i, f"all of them {i % 3}") for i in range(200)],
                                  "doc_id long, text string")
    terms = match.search_terms(spark.createDataFrame(
        [("A", "all"), ("B", "them 1"), ("C", "of 2")], "ticker string, company_name string"))
    counts = match.word_counts(texts, terms, "text", False)
    hits = texts.select(F.xxhash64("doc_id").alias("_row"), F.lit("all").alias("anchor"))
    dealt, copied = match._salted(hits, match.anchored(terms, counts), counts)
    assert dealt.select("_salt").distinct().count() == 10
    assert copied.filter("phrase = 'all'").count() == 10
    got = match.match_entities(texts, terms, max_terms=0)
    assert sorted(map(tuple, got.collect())) == sorted(
        [("A", i) for i in range(200)] + [("B", i) for i in range(200) if i % 3 == 1])


def test_replies_of_the_wrong_kind_and_nan(spark):
    asked = spark.createDataFrame([("a",)], "x string")
    for reply in ({"extracted_news": []}, 5, None):
        said = asked.select(news.score_json(lambda: lambda text: reply)("x")).first()[0]
        assert "error" in json.loads(said)
    scores = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "s double")
    assert [r[0] for r in scores.select(news.clamp_score("s")).collect()] == [None, 1.0, None]
