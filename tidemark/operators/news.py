"""News per key: newest items, grouping to JSON, scoring, and back to rows."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import in_run_window
from ..functions.text import count_words, words
from ..schemas import REPLY
from .pick import top_per_key

# Items kept without a scorer, items a scorer is shown, items it may pick.
NEWEST, SHOWN, PICKED = 3, 20, 3
# Items a search returns, daily and at the first load, and the days it reaches back.
DAILY_RESULTS, FIRST_RESULTS, FIRST_DAYS = 15, 20, 90

Scorer = Callable[[str], str]


def newest_first() -> list[Column]:
    """Newest first, undated items last; title and summary settle equal times."""
    return [F.col("publication_date").desc_nulls_last(), F.col("title").asc_nulls_last(),
            F.col("summary").asc_nulls_last()]


def newest_news(news: DataFrame, k: int = NEWEST, key: str = "ticker") -> DataFrame:
    return top_per_key(news, key, newest_first(), k)


def pulled_news(news: DataFrame, run: Column, first: bool = False) -> DataFrame:
    """What one pull brings: the newest items of the run day, or of the days before a first run."""
    window = (in_run_window("publication_date", run, FIRST_DAYS, 0) if first
              else in_run_window("publication_date", run, 0, 1))
    return newest_news(news.filter(window), FIRST_RESULTS if first else DAILY_RESULTS)


def neutral_news(news: DataFrame) -> DataFrame:
    """The newest items with a neutral score: what is published without a scorer."""
    return newest_news(news).select(
        "ticker", "title", F.lit(0.0).alias("sentiment_score"), "summary",
        F.to_date("publication_date").alias("news_date"),
    )


def group_news(news: DataFrame, k: int = SHOWN) -> DataFrame:
    """The ``k`` newest items per ticker, newest first, as one array of structs.

    The limit comes before the grouping, so no group holds more than ``k`` items.
    """
    ranked = top_per_key(news, "ticker", newest_first(), k, rank="_rank")
    item = F.struct("_rank", "title", "summary", "publication_date")
    return ranked.groupBy("ticker").agg(F.sort_array(F.collect_list(item)).alias("items"))


def items_json(items: Column | str = "items") -> Column:
    """What a scorer is sent: titles and summaries."""
    return F.to_json(F.transform(items, lambda i: F.struct(i["title"].alias("title"),
                                                           i["summary"].alias("summary"))))


def news_to_json(news: DataFrame, k: int = SHOWN) -> DataFrame:
    return group_news(news, k).select("ticker", items_json().alias("news_json"))


def with_retry(call: Scorer, attempts: int = 3, multiplier: float = 1.0, shortest: float = 2.0,
               longest: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> Scorer:
    """``call`` tried again with doubled waits; the last error is raised."""
    @wraps(call)
    def retried(text: str) -> str:
        for attempt in range(attempts):
            try:
                return call(text)
            except Exception:
                if attempt + 1 == attempts:
                    raise
                sleep(max(shortest, min(longest, multiplier * 2 ** attempt)))
        raise ValueError("attempts must be positive")
    return retried


def score_json(make_scorer: Callable[[], Scorer]) -> Callable[[Column | str], Column]:
    """Pandas UDF that asks a scorer for each JSON text.

    The scorer is made once per task. A failed call becomes a reply without news that carries
    the error, so a bad item never fails the job; an empty input is answered without a call.
    """
    def reply(scorer: Scorer, text: str | None) -> str:
        if not text:
            return "{}"
        try:
            said = scorer(text)
            if not isinstance(said, str):
                raise TypeError(f"the reply is {type(said).__name__}, not text")
            return said
        except Exception as error:
            return json.dumps({"extracted_news": [], "error": str(error)})

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for batch in batches:
            yield pd.Series([reply(scorer, t) for t in batch], dtype="object")

    return ask


def clamp_score(score: Column | str) -> Column:
    """Between -1 and 1; null for what is no number."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s.isNotNull() & ~F.isnan(s), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s)))


def reply_picks(reply: Column | str = "reply", k: int = PICKED) -> Column:
    """The first ``k`` items of a JSON reply; null for a malformed one."""
    return F.slice(F.from_json(reply, REPLY)["extracted_news"], 1, k)


def parse_replies(replies: DataFrame, k: int = PICKED) -> DataFrame:
    """Rows (ticker, title, sentiment_score, summary) of the column ``reply``."""
    return replies.select("ticker", F.explode(reply_picks(k=k)).alias("_item")).select(
        "ticker", F.col("_item.title").alias("title"),
        clamp_score("_item.sentiment_score").alias("sentiment_score"),
        F.col("_item.summary").alias("summary"),
    )


def attach_dates(picks: DataFrame, news: DataFrame) -> DataFrame:
    """Dates for scored items, by ticker and title; the newest where a title came twice."""
    dates = news.groupBy("ticker", "title").agg(
        F.to_date(F.max("publication_date")).alias("news_date"))
    return picks.join(dates, on=["ticker", "title"], how="left").select(
        "ticker", "title", "sentiment_score", "summary", "news_date")


def scored_news(news: DataFrame, make_scorer: Callable[[], Scorer] | None) -> DataFrame:
    """Silver news: picked and scored, or the newest with a neutral score without a scorer."""
    if make_scorer is None:
        return neutral_news(news)
    replies = group_news(news).withColumn("reply", score_json(make_scorer)(items_json()))
    # The date is looked up among the few items of the same row, which saves a second pass
    # over the news and a join.
    picked = replies.select("ticker", "items", F.explode(reply_picks()).alias("_item"))
    same_title = F.filter("items", lambda i: i["title"] == F.col("_item.title"))
    return picked.select(
        "ticker", F.col("_item.title").alias("title"),
        clamp_score("_item.sentiment_score").alias("sentiment_score"),
        F.col("_item.summary").alias("summary"),
        F.to_date(F.array_max(F.transform(same_title, lambda i: i["publication_date"])))
        .alias("news_date"),
    )


def lexicon_score(word_list: Column | str, positive: Sequence[str],
                  negative: Sequence[str]) -> Column:
    """(positive - negative) / (positive + negative) words, 0 without any.

    The words of either list are picked out once and bound to a variable by the outer transform;
    a plain expression would pick them out again wherever it names them.
    """
    listed = F.filter(word_list, lambda w: w.isin(*positive, *negative))

    def score(found: Column) -> Column:
        p, n = count_words(found, positive), count_words(found, negative)
        return F.try_divide((p - n).cast("double"), (p + n).cast("double"))

    return F.coalesce(F.get(F.transform(F.array(listed), score), F.lit(0)), F.lit(0.0))


def lexicon_news(news: DataFrame, positive: Sequence[str], negative: Sequence[str],
                 k: int = PICKED) -> DataFrame:
    """Picked and scored by word lists, all in SQL: strongest scores of the newest items."""
    shown = newest_news(news, SHOWN).withColumn(
        "sentiment_score",
        lexicon_score(words(F.concat_ws(" ", "title", "summary")), positive, negative))
    order = [F.abs("sentiment_score").desc(), *newest_first()]
    return top_per_key(shown, "ticker", order, k).select(
        "ticker", "title", "sentiment_score", "summary",
        F.to_date("publication_date").alias("news_date"),
    )
