"""Feeds derived from the test tables, as SQL that reads the same in Spark and DuckDB.

Prices are whole numbers: their sums are exact, so the order of summation cannot show.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators.statements import EARNINGS_LINE, INFO_METRICS
from ..session import configure

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_INFO_NAMES = (*INFO_METRICS, "unknownKey")

FEEDS = {
    # Daily prices: suppliers are tickers, ship dates are trading days.
    "px": """
        select ticker, date, case when volume % 2 = 0 then low else high end as open, high, low,
               case when volume % 2 = 0 then high else low end as close, volume
        from (select cast(l_suppkey as string) as ticker, cast(l_shipdate as date) as date,
                     cast(floor(max(l_extendedprice)) as double) as high,
                     cast(floor(min(l_extendedprice)) as double) as low,
                     cast(sum(l_quantity) as bigint) as volume
              from {lineitem} group by l_suppkey, cast(l_shipdate as date)) g
    """,
    # Two overlapping feeds; the daily one has another close, so the surviving copy shows.
    "px_hist": "select * from {px} where date < date '2001-01-01'",
    "px_day": """
        select ticker, date, open, high, low, high as close, volume
        from {px} where date >= date '2000-07-01'
    """,
    # Prices as a file has them, with bad cells and a volume beyond 32 bits.
    "px_text": """
        select ticker, cast(date as string) as Date,
               case when volume % 19 = 0 then 'n/a' else cast(cast(open as bigint) as string) end
                   as Open,
               cast(cast(high as bigint) as string) as High,
               cast(cast(low as bigint) as string) as Low,
               cast(cast(close as bigint) as string) as Close,
               case when volume % 17 = 0 then '3000000000' when volume % 23 = 0 then ''
                    else concat(cast(volume as string), '.0') end as Volume
        from {px}
    """,
    # Snapshots: items by the day of their order. Nulls, zeros, NaN and weekend dates are all there.
    "metrics_raw": """
        select cast(l_suppkey as string) as ticker, cast(year(o_orderdate) as int) as year,
               cast(month(o_orderdate) as int) as month, cast(day(o_orderdate) as int) as day,
               case when l_tax = 0.01 then cast('NaN' as double) when l_tax = 0 then null
                    else l_quantity / 4 end as ev_ebitda,
               case when l_quantity < 5 then null when l_quantity > 48 then cast(0 as double)
                    else l_extendedprice / 100 end as book_value,
               l_discount as dividend_yield, l_tax as payout_ratio,
               cast(floor(l_extendedprice) as double) as target_mean_price,
               cast(cast(l_quantity as bigint) % 5 as double) as recommendation_mean,
               cast(floor(l_extendedprice / 2) as double) as fifty_two_week_low,
               cast(floor(l_extendedprice * 2) as double) as fifty_two_week_high,
               cast(floor(o_totalprice - 200000) as bigint) as earnings,
               cast(floor(o_totalprice) as bigint) * case o_orderkey % 4 when 0 then 1
                    when 1 then 1000 when 2 then 1000000 else 10000000 end as market_cap,
               case when l_discount = 0 then cast(0 as bigint)
                    else cast(l_quantity as bigint) * 1000 end as shares_outstanding,
               o_orderkey % 1000 as free_float, l_orderkey as src_id, l_partkey as src_id2
        from {lineitem} join {orders} on l_orderkey = o_orderkey
    """,
    # A rate per order day; those of a weekend roll onto Monday.
    "rates_raw": """
        select cast(year(d) as int) as year, cast(month(d) as int) as month,
               cast(day(d) as int) as day, cast(300 + n % 400 as double) / 10000 as risk_free_rate
        from (select cast(o_orderdate as date) as d, sum(o_orderkey) as n from {orders}
              group by cast(o_orderdate as date)) g
    """,
    # Profiles: those of suppliers in debt are listed elsewhere and meet no prices.
    "profiles_raw": """
        select concat(cast(s_suppkey as string), case when s_acctbal > 0 then '' else '.X' end)
               as ticker, s_name as company_name, r_name as sector,
               n_name as industry
        from {supplier} join {nation} on s_nationkey = n_nationkey
             join {region} on n_regionkey = r_regionkey
    """,
    # News, errors landed twice; those of customers in debt are of companies listed elsewhere.
    "news_raw": """
        with landed as (
            select concat(cast(user_id as string), case when c_acctbal > 0 then '' else '.X' end)
                   as ticker, event_type,
                   concat(event_type, '-', cast(event_id as string)) as title,
                   props as summary, {feed_time} as publication_date
            from {events} left join {customer} on user_id = c_custkey
        )
        select ticker, title, summary, publication_date from landed
        union all
        select ticker, title, summary, publication_date from landed where event_type = 'error'
    """,
    # Statement lines, one value per period, some of them null.
    "statement_lines": f"""
        select cast(l_suppkey as string) as ticker,
               case l_returnflag when 'N' then '{EARNINGS_LINE}' when 'R' then 'Total Revenue'
                    else 'EBITDA' end as label,
               cast(l_shipdate as date) as period,
               case when cast(sum(l_quantity) as bigint) % 5 = 0 then null
                    else cast(floor(max(l_extendedprice)) as bigint) end as value
        from {{lineitem}} group by l_suppkey, l_returnflag, cast(l_shipdate as date)
    """,
    # Company information as name and value, with a name that no metric has.
    "company_info": f"""
        select ticker, case n {' '.join(f"when {i} then '{name}'"
                                        for i, name in enumerate(_INFO_NAMES))} end as name,
               max(value) as value
        from (select cast(l_suppkey as string) as ticker,
                     cast(l_quantity as int) % {len(_INFO_NAMES)} as n,
                     cast(case when l_linestatus = 'O' and l_discount = 0.1 then 0
                               else floor(l_extendedprice) end as double) as value
              from {{lineitem}}) g
        group by ticker, n
    """,
    # News texts: documents, to which events lend a time; those without one are undated.
    "texts": """
        select doc_id as id, heading as title, text as summary, ts
               as publication_date
        from (select doc_id, text, concat(source, ' ', lang) as heading
              from {documents}) d
        left join (select event_id, {seconds} as ts from {events}) e on doc_id = event_id
    """,
    # Searched companies: a whole benchmark passage as name, its number as code.
    "entities": """
        select distinct concat(cast(item_id as string), '.ID') as ticker, text as company_name
        from {benchmark}
    """,
    # Rate pages: one per order, some of which quote no rate, or not where it belongs, or with
    # references for signs; comments and scripts hold other rates.
    "rate_pages": """
        select o_orderkey as page_id,
               concat('<html><!-- <h2 id="description">1.11%</h2> --><script>"<h2 id=description>',
                      '2.22%</h2>"</script><h1>9.99%</h1><p id="description">8.88%</p><H2 class="x" ',
                      case when o_orderstatus = 'P' then 'id="other"' else 'id="description"' end,
                      '>The <b>yield</b> &amp; rate rose to ',
                      cast(cast(floor(o_totalprice / 1000) as bigint) as string),
                      case when o_orderpriority = '5-LOW' then ' points'
                           when o_orderkey % 3 = 0 then '&#46;&#x32;5&percnt;'
                           when o_orderkey % 3 = 1 then '&period;25&#37' else '.25%' end,
                      '</H2><h2 id="description">7.77%</h2></html>') as html
        from {orders}
    """,
    # Intraday quotes with few keys, each holding a fifth of the rows.
    "ticks": """
        select event_type as ticker, event_id as seq, cast(floor(value * 100) as double) as close
        from {events}
    """,
}

_SPARK = {
    "seconds": "cast(date_trunc('SECOND', ts) as timestamp)",
    "feed_time": "concat(date_format(ts, 'EEE, dd MMM yyyy HH:mm:ss'), ' GMT')",
}
_DUCKDB = {
    "seconds": "date_trunc('second', ts)",
    "feed_time": "strftime(ts, '%a, %d %b %Y %H:%M:%S GMT')",
}


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived feed as a DataFrame."""
    configure(spark)
    text = FEEDS[name]
    for key, value in _SPARK.items():
        text = text.replace("{%s}" % key, value)
    parts = {
        n: feed(spark, sf_dir, n) if n in FEEDS else table(spark, sf_dir, n)
        for n in _names(text)
    }
    return spark.sql(text, **parts)


def feed_ctes(*names: str) -> list[str]:
    """The same feeds as DuckDB common table expressions, in order of need."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        text = FEEDS[name]
        for key, value in _DUCKDB.items():
            text = text.replace("{%s}" % key, value)
        for n in _names(text):
            if n in FEEDS:
                add(n)
            text = text.replace("{%s}" % n, n)
        done[name] = f"{name} as ({text})"

    for name in names:
        add(name)
    return list(done.values())
