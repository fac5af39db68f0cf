"""SQL twins of the registered queries, for DuckDB over the same tables.

Written from the rules, not from the operators: literal frames, sorted lists and plain joins.
"""

from __future__ import annotations

from ..functions.display import METRIC_LABELS
from ..operators.serve import CHART_NAMES, SNAPSHOT_NAMES
from ..operators.series import FILLED, RETURN_LAGS, SMA_ROWS
from ..operators.statements import EARNINGS_LINE, INFO_METRICS
from ..plans.silver import FACT_COLUMNS, PRICE_COLUMNS, SMA_COLUMNS
from ..schemas import METRICS
from .inputs import TABLES, feed_ctes
from .queries import (
    CHART_TICKER, CHARTED, FIRST_RUN_DAY, NEGATIVE, POSITIVE, PROSE_NEGATIVE, PROSE_POSITIVE, RUN_DAY,
    WANTED,
)

W = "partition by ticker order by date"


def _q(name: str) -> str:
    return f'"{name}"'


def _list(names) -> str:
    return ", ".join(_q(n) for n in names)


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


ROLL = """case dayofweek({d}) when 0 then {d} + 1 when 6 then {d} + 2 else {d} end"""
RAW_DATE = "make_date(year, month, day)"

# Steps after the feeds, each as a common table expression: (feeds and steps needed, SQL).
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "metrics": (("metrics_raw",), f"""
        select ticker, date, {_list(METRICS)} from (
          select *, row_number() over (partition by ticker, date order by raw_date desc,
                 src_id desc, src_id2 desc, {', '.join(
                     f'{m} desc nulls last' for m in (
                         'ev_ebitda', 'book_value', 'dividend_yield', 'payout_ratio',
                         'target_mean_price', 'recommendation_mean', 'fifty_two_week_low',
                         'fifty_two_week_high', 'earnings', 'market_cap', 'shares_outstanding',
                         'free_float'))}) as rn
          from (select * replace (nullif(ev_ebitda, cast('NaN' as double)) as ev_ebitda),
                       {RAW_DATE} as raw_date, cast({ROLL.format(d=RAW_DATE)} as date) as date
                from metrics_raw) r) t
        where rn = 1"""),
    "rates": (("rates_raw",), f"""
        select date, risk_free_rate from (
          select *, row_number() over (partition by date order by raw_date desc,
                 risk_free_rate desc) as rn
          from (select *, {RAW_DATE} as raw_date,
                       cast({ROLL.format(d=RAW_DATE)} as date) as date from rates_raw) r) t
        where rn = 1"""),
    "news": (("news_raw",), """
        select distinct ticker, title, summary,
               strptime(publication_date, '%a, %d %b %Y %H:%M:%S GMT') as ts from news_raw"""),
    "profiles": (("profiles_raw",), """
        select ticker, company_name, lower(sector) as sector, lower(industry) as industry
        from profiles_raw"""),
    "top3": (("news",), """
        select ticker, title, cast(0 as double) as sentiment_score, summary,
               cast(ts as date) as news_date
        from (select *, row_number() over (partition by ticker order by ts desc nulls last,
                     title, summary) as rn from news) t where rn <= 3"""),
    "top20": (("news",), """
        select * from (select *, row_number() over (partition by ticker order by
                       ts desc nulls last, title, summary) as rn from news) t
        where rn <= 20"""),
    "scored": (("top20",), f"""
        select ticker, title, sentiment_score, summary, cast(ts as date) as news_date
        from (select *, row_number() over (partition by ticker order by abs(sentiment_score) desc,
                     ts desc nulls last, title, summary) as pick
              from (select *, case when p + n = 0 then 0.0
                                   else cast(p - n as double) / (p + n) end as sentiment_score
                    from (select *,
                            len(list_filter(words, lambda w: w in ({_texts(POSITIVE)}))) as p,
                            len(list_filter(words, lambda w: w in ({_texts(NEGATIVE)}))) as n
                          from (select *, string_split(trim(regexp_replace(
                                       lower(title || ' ' || summary),
                                       '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as words
                                from top20) a) b) c) d
        where pick <= 3"""),
    "joined": (("px", "metrics", "rates"), f"""
        select px.*, {_list(METRICS)}, risk_free_rate from px
        left join metrics using (ticker, date) left join rates using (date)"""),
    "enriched": (("joined",), f"""
        select ticker, date, open, high, low, close, volume, {', '.join(
            f'''coalesce(last_value({c} ignore nulls) over past,
                         first_value({c} ignore nulls) over whole) as {c}''' for c in FILLED)}
        from joined
        window past as ({W} rows between unbounded preceding and current row),
               whole as ({W} rows between unbounded preceding and unbounded following)"""),
    "returned": (("enriched",), f"""
        select *, {', '.join(
            f'avg(close) over ({W} rows between {n - 1} preceding and current row) as sma_{n}'
            for n in SMA_ROWS)}, {', '.join(
            f'(close - lag(close, {n}) over ({W})) / nullif(lag(close, {n}) over ({W}), 0) '
            f'as {_q(name)}' for name, n in RETURN_LAGS.items())}
        from enriched"""),
    "risk": (("returned",), f"""
        select *, avg("1d_return") over w as m, stddev_samp("1d_return") over w as s,
               quantile_disc("1d_return", 0.05) over w as var_95_252d
        from returned
        window w as ({W} rows between 251 preceding and current row)"""),
    "fact": (("risk",), f"""
        select {', '.join('t.' + _q(c) for c in FACT_COLUMNS)} from (
          select * replace (cast(free_float as double) / nullif(shares_outstanding, 0)
                            as free_float),
                 round(case when s > 0 then (m - coalesce(risk_free_rate, 0.0::double) / 252)
                       / s * sqrt(252.0::double) end, 6) as sharpe_ratio_252d,
                 close / nullif(book_value, 0) as "PBV",
                 cast(earnings as double) / nullif(shares_outstanding, 0) as "EPS",
                 close / nullif(cast(earnings as double) / nullif(shares_outstanding, 0), 0)
                     as "PER"
          from risk) t"""),
    "latest": (("fact",), f"""
        select {_list(c for c in FACT_COLUMNS if c not in (*PRICE_COLUMNS, *SMA_COLUMNS))}
        from (select *, row_number() over (partition by ticker order by date desc) as rn
              from fact) t where rn = 1"""),
    "snapshot": (("latest", "profiles", "top3"), """
        select * from latest join profiles using (ticker) left join top3 using (ticker)"""),
    "chart": (("px",), f"""
        select ticker, date, close, high, low, open, volume, {', '.join(
            f'avg(close) over ({W} rows between {n - 1} preceding and current row) as sma_{n}'
            for n in SMA_ROWS)} from px"""),
    "served": (("snapshot",), f"""
        select {', '.join(
            (f'cast({_q(s)} as double) as {_q(t)}'
             if s not in ('ticker', 'date', 'title', 'summary', 'company_name', 'sector',
                          'industry', 'news_date') else f'{_q(s)} as {_q(t)}')
            for s, t in SNAPSHOT_NAMES.items())}, cast("12m_return" as double) as return_12m
        from snapshot"""),
    "served_chart": (("chart",), f"""
        select {', '.join(
            (f'cast({_q(s)} as double) as {_q(t)}' if s not in ('ticker', 'date')
             else f'{_q(s)} as {_q(t)}') for s, t in CHART_NAMES.items())} from chart"""),
    "records": (("served",), """
        select * exclude (rn) from (
          select *, row_number() over (partition by ticker order by news_date desc nulls last,
                 news_title nulls last, news_summary nulls last) as rn
          from served where ticker is not null and ticker <> '') t where rn = 1"""),
    "visible": (("records",), " union all ".join(
        f"""select ticker, cast({i} as int) as position, '{m}' as metric, '{label}' as label,
                   {m} as value from records where {m} is not null and {m} <> 0"""
        for i, (m, label) in enumerate(METRIC_LABELS.items(), 1) if m != "turnover")),
    "docs": ((), r"""
        select doc_id, n_chars, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))
               as spaced from documents"""),
}


def sql(body: str, *needs: str) -> str:
    """``body`` behind the common table expressions it needs."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        if name not in STEPS:
            for cte in feed_ctes(name):
                done.setdefault(cte.split(" ", 1)[0], cte)
            return
        parents, text = STEPS[name]
        for parent in parents:
            add(parent)
        done[name] = f"{name} as ({text})"

    for need in needs:
        add(need)
    return (f"with {', '.join(done.values())} " if done else "") + body


def _fills(kind: str) -> str:
    past = "last_value({c} ignore nulls) over past"
    exprs = {
        "ffill": past,
        # The literal frame: from the current row to the end, where nothing came before.
        "bfill": f"""case when {past} is null then first_value({{c}} ignore nulls) over future
                     else {{c}} end""",
    }
    cols = ", ".join(f"{exprs[kind].format(c=c)} as {c}" for c in FILLED)
    return sql(f"""select ticker, date, {cols} from joined
        window past as ({W} rows between unbounded preceding and current row),
               future as ({W} rows between current row and unbounded following)""", "joined")


def _fact(columns: str = "*") -> str:
    return sql(f"select {columns} from fact", "fact")


_METRIC_TEXT = """case
    when metric = 'ytd_return' then format('{:.2f}%', value)
    when metric in ('market_cap', 'turnover') then case
        when abs(value) >= 1e12 then format('${:.2f}T', value / 1e12::double)
        when abs(value) >= 1e9 then format('${:.2f}B', value / 1e9::double)
        when abs(value) >= 1e6 then format('${:.2f}M', value / 1e6::double)
        else format('${:,.0f}', value) end
    when metric in ('high_52w', 'low_52w') then format('${:,.2f}', value)
    when abs(value) < 10 then format('{:,.4f}', value)
    else format('{:,.2f}', value) end"""


def _sentiment(score: str) -> str:
    return (f"case when {score} is null then null when {score} > 0 then 'Bullish' "
            f"when {score} < 0 then 'Bearish' else 'Neutral' end")


def _sentiment_text(score: str) -> str:
    return f"{_sentiment(score)} || ' (' || format('{{:+.3f}}', {score}) || ')'"


_ELEMENT = r"""case when regexp_matches(html, '(?is)<{tag}{attrs}>(.*?)</{tag}\s*>') then
    replace(replace(replace(replace(replace(
        regexp_replace(regexp_extract(html, '(?is)<{tag}{attrs}>(.*?)</{tag}\s*>', 1),
                       '<[^>]+>', '', 'g'),
        '&quot;', '"'), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') end"""
_ANY = r"(?:\s[^>]*)?"
_SHOWN = r"""(select page_id, regexp_replace(regexp_replace(regexp_replace(html,
    '<!--.*?-->', '', 'gs'), '<script.*?</script *>', '', 'gis'), '<style.*?</style *>', '', 'gis')
    as html from pages)"""

ALL_PRICES = "ticker, date, open, high, low, close, volume"

_UNION = f"""select ticker, date, open, high, low, close, volume from (
    select *, row_number() over (partition by ticker, date order by feed desc,
           volume desc nulls last, close desc nulls last, low desc nulls last,
           high desc nulls last, open desc nulls last) as rn
    from (select {ALL_PRICES}, 0 as feed from px_hist
          union all select {ALL_PRICES}, 1 as feed from px_day) u) t where rn = 1"""

_SMA = ", ".join(
    f"avg(close) over ({W} rows between {n - 1} preceding and current row) as sma_{n}"
    for n in SMA_ROWS)
_ONE_DAY = (f"(select ticker, date, close, (close - lag(close) over ({W})) "
            f"/ nullif(lag(close) over ({W}), 0) as \"1d_return\" from px) r")
_RISK_ROWS = f"({W} rows between 251 preceding and current row)"
_FILL_BOTH = sql(f"select ticker, date, {_list(FILLED)} from enriched", "enriched")
_SMA_SQL = sql(f"select ticker, date, close, {_SMA} from px", "px")
_TICKS = "partition by ticker order by seq"

_SCORES = r"""(select doc_id, len(words) as word_count,
    case when p + n = 0 then 0.0 else cast(p - n as double) / (p + n) end as score
  from (select *, len(list_filter(words, lambda w: w in ({pos}))) as p,
                  len(list_filter(words, lambda w: w in ({neg}))) as n
        from (select doc_id, list_filter(string_split(spaced, ' '), lambda w: w <> '') as words
              from docs) a) b) s""".format(pos=_texts(PROSE_POSITIVE), neg=_texts(PROSE_NEGATIVE))

_WANTED = "(values " + ", ".join(f"('{t}')" for t in WANTED) + ") wanted(ticker)"

_LATEST_VALUE = """(select ticker, label, value from (
    select *, row_number() over (partition by ticker, label order by period desc) as rn
    from statement_lines) t where rn = 1)"""

_PIVOT = "select ticker, " + ", ".join(
    f"max(case when name = '{source}' then value end) as {metric}"
    for source, metric in INFO_METRICS.items()) + " from company_info group by ticker"

_NEWS_COLUMNS = "ticker, title, sentiment_score, summary, news_date"

_TERMS = r"""(select distinct ticker,
    trim(regexp_replace(lower(term), '[^\p{L}\p{N}]+', ' ', 'g')) as phrase
    from (select ticker, company_name as term from entities
          union all select ticker, replace(ticker, '.ID', '') from entities) a)"""

ORACLES: dict[str, str] = {
    "scan_json_schema": sql("select * from profiles_raw", "profiles_raw"),
    "scan_json_partitioned": sql(f"""
        select ticker, year, month, day,
               nullif(ev_ebitda, cast('NaN' as double)) as ev_ebitda,
               {_list(m for m in METRICS if m != 'ev_ebitda')}
        from (select *, row_number() over (partition by ticker, year, month, day order by
                {', '.join(f'{m} desc nulls last' for m in METRICS)}) as rn
              from metrics_raw) t where rn = 1""", "metrics_raw"),
    "scan_json_rates": sql("select * from rates_raw", "rates_raw"),
    "scan_json_news": sql("""
        select title, summary, publication_date, ticker, cast(year(ts) as int) as year,
               cast(month(ts) as int) as month, cast(day(ts) as int) as day
        from (select *, strptime(publication_date, '%a, %d %b %Y %H:%M:%S GMT') as ts
              from news_raw) n""", "news_raw"),
    "scan_csv_glob": sql(_UNION, "px_hist", "px_day"),
    "scan_parquet": sql("select ticker, date, close from px", "px"),
    "scan_inline": sql(f"""select ticker, max(close) as highest_close, count(*) as days from px
        where ticker in ({_texts(WANTED)}) group by ticker""", "px"),
    "run_date_parts": sql(f"""
        select src_id, src_id2, ticker, {RAW_DATE} as run_date,
               try_cast(printf('%04d-%02d-%02d', year, month, day + 28) as date) as shifted_date,
               printf('%04d', year) as year_part, printf('%02d', month) as month_part,
               printf('%02d', day) as day_part from metrics_raw""", "metrics_raw"),
    "sink_overwrite": sql(f"select {ALL_PRICES} from px", "px"),
    "sink_partitioned": sql(f"select {ALL_PRICES} from px", "px"),
    "sink_clustered": sql(f"select {ALL_PRICES} from px", "px"),
    "sink_dynamic_partition": sql(f"""
        select {ALL_PRICES} from px where (ticker, year(date)) not in
            (select ticker, year(date) from px_day)
        union all select {ALL_PRICES} from px_day""", "px", "px_day"),
    "profiles_silver": sql("select * from profiles", "profiles"),
    "prices_clean": sql("""
        select ticker, cast("Date" as date) as date, try_cast("Open" as double) as open,
               try_cast("High" as double) as high, try_cast("Low" as double) as low,
               try_cast("Close" as double) as close,
               cast(floor(try_cast("Volume" as double)) as bigint) as volume
        from px_text""", "px_text"),
    "prices_union_dedup": sql(_UNION, "px_hist", "px_day"),
    "dedup_exact": sql("select distinct * from news_raw", "news_raw"),
    "dedup_by_key": sql("""select ticker, title, min(summary) as summary, publication_date
        from news_raw group by ticker, title, publication_date""", "news_raw"),
    "weekend_roll": sql(f"""select src_id, src_id2, ticker, {RAW_DATE} as raw_date,
        cast({ROLL.format(d=RAW_DATE)} as date) as date from metrics_raw""", "metrics_raw"),
    "metrics_clean": sql("select * from metrics", "metrics"),
    "riskfree_clean": sql("select * from rates", "rates"),
    "parse_rfc822": sql("""select ticker, title, cast(epoch(ts) as bigint) as epoch,
        cast(ts as date) as news_date
        from (select ticker, title, strptime(publication_date, '%a, %d %b %Y %H:%M:%S GMT') as ts
              from news_raw) n""", "news_raw"),
    "extract_html": "select page_id, {title} as title, {h1} as heading, {h2} as description "
                    "from {shown} p".format(
        shown=_SHOWN, title=_ELEMENT.format(tag="title", attrs=_ANY), h1=_ELEMENT.format(tag="h1", attrs=_ANY),
        h2=_ELEMENT.format(tag="h2", attrs=r'\s[^>]*id\s*=\s*"?description"?' + _ANY)),
    "extract_percent": r"""
        select rate, count(*) as pages from (
          select cast(nullif(regexp_extract(page, '([0-9]+\.[0-9]+)%', 1), '') as double) / 100
                 as rate
          from (select printf('The rate is %.2f%% now, after %.1f%%.', l_discount * 100,
                              l_tax * 100) as page from lineitem
                union all select html from pages union all select text from documents) p) r
        group by rate""",
    "join_snapshots": sql("""select ticker, date, close, book_value, earnings,
        shares_outstanding, free_float from joined""", "joined"),
    "join_global_series": sql("select ticker, date, close, risk_free_rate from joined", "joined"),
    "trading_day_gate": sql(f"""select {ALL_PRICES} from px
        where date in (select date from px where ticker = '0')""", "px"),
    "ffill": _fills("ffill"),
    "bfill": _fills("bfill"),
    "fill_both": _FILL_BOTH,
    "fill_both_split": _FILL_BOTH,
    "enrich_market": sql("select * from enriched", "enriched"),
    "sma": _SMA_SQL,
    "sma_split": _SMA_SQL,
    "ticks_hot_key": sql(f"""
        select ticker, seq, close, {_SMA.replace(W, _TICKS)}, "1d_return", "12m_return",
               quantile_disc("1d_return", 0.05) over ({_TICKS} rows between 251 preceding
                   and current row) as var_95_252d
        from (select *, (close - lag(close, 1) over ({_TICKS}))
                         / nullif(lag(close, 1) over ({_TICKS}), 0) as "1d_return",
                     (close - lag(close, 252) over ({_TICKS}))
                         / nullif(lag(close, 252) over ({_TICKS}), 0) as "12m_return"
              from ticks) t""", "ticks"),
    "returns": sql(f"""select ticker, date, close, {', '.join(
        f'(close - lag(close, {n}) over ({W})) / nullif(lag(close, {n}) over ({W}), 0) '
        f'as {_q(name)}' for name, n in RETURN_LAGS.items())} from px""", "px"),
    "rolling_moments": sql(f"""select ticker, date, close, "1d_return",
        round(avg("1d_return") over {_RISK_ROWS}, 6) as mean_1d_return,
        round(stddev_samp("1d_return") over {_RISK_ROWS}, 6) as stddev_1d_return
        from {_ONE_DAY}""", "px"),
    "sharpe_252": _fact("ticker, date, sharpe_ratio_252d"),
    "var_95": sql(f"""select ticker, date, quantile_disc("1d_return", 0.05) over {_RISK_ROWS}
        as var_95_252d from {_ONE_DAY}""", "px"),
    "ratios": _fact('ticker, date, "PBV", "EPS", "PER", free_float'),
    "market_and_risk": _fact(),
    "market_and_risk_split": _fact(),
    "news_top3": sql("select * from top3", "top3"),
    "news_window": sql(f"""
        select 'daily' as pull, ticker, title, cast(ts as date) as news_date from news
        where ts >= date '{RUN_DAY}' and ts < date '{RUN_DAY}' + 1
        union all
        select 'first' as pull, ticker, title, cast(ts as date) as news_date from news
        where ts >= date '{FIRST_RUN_DAY}' - 90 and ts < date '{FIRST_RUN_DAY}'""", "news"),
    "news_pull": sql(f"""
        select pull, ticker, title, cast(epoch(ts) as bigint) as epoch
        from (select *, row_number() over (partition by pull, ticker order by ts desc, title,
                     summary) as rn
              from (select 'daily' as pull, 15 as k, * from news
                    where ts >= date '{RUN_DAY}' and ts < date '{RUN_DAY}' + 1
                    union all select 'first' as pull, 20 as k, * from news
                    where ts >= date '{FIRST_RUN_DAY}' - 90 and ts < date '{FIRST_RUN_DAY}') w) r
        where rn <= k""", "news"),
    "news_to_json": sql("""select ticker, cast(count(*) as int) as items,
        string_agg(title, '|' order by rn) as titles,
        string_agg(summary, '|' order by rn) as summaries from top20 group by ticker""", "top20"),
    "news_scored": sql(f"select {_NEWS_COLUMNS} from scored", "scored"),
    "news_scored_service": sql(f"select {_NEWS_COLUMNS} from scored", "scored"),
    "news_attach_dates": sql(f"select {_NEWS_COLUMNS} from scored", "scored"),
    "sentiment_label": sql(f"""select doc_id, cast(word_count as int) as word_count, score,
        {_sentiment('score')} as sentiment, {_sentiment_text('score')} as sentiment_text
        from {_SCORES}""", "docs"),
    "entity_match": sql(r"""
        select ticker, doc_id, n_chars, cast(rank as int) as rank from (
          select *, row_number() over (partition by ticker order by n_chars desc, doc_id) as rank
          from (select distinct ticker, doc_id, n_chars
                from """ + _TERMS + r""" terms join docs on phrase <> ''
                     and contains(' ' || spaced || ' ', ' ' || phrase || ' ')) m) r
        where rank <= 15""", "entities", "docs"),
    "rate_pages": sql("""
        select o_orderkey as page_id, (floor(o_totalprice / 1000) + 0.25::double) / 100
               as risk_free_rate
        from orders where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'
        union all
        select o_orderkey, 7.77::double / 100 from orders where o_orderstatus = 'P'"""),
    "news_of_entities": sql(r"""
        select ticker, id as doc_id, title, cast(epoch(publication_date) as bigint) as epoch
        from (select *, row_number() over (partition by ticker order by publication_date desc,
                     title, summary) as rn
              from (select distinct ticker, id, title, summary, publication_date
                    from """ + _TERMS + rf""" terms
                    join (select *, ' ' || trim(regexp_replace(lower(title || ' ' || summary),
                                 '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ' as said from texts) t
                    on phrase <> '' and contains(said, ' ' || phrase || ' ')
                    where publication_date >= date '{FIRST_RUN_DAY}' - 90
                      and publication_date < date '{FIRST_RUN_DAY}') m) r
        where rn <= 20""", "entities", "texts"),
    "metric_snapshot": sql(f"""
        select ticker, {', '.join(m for m in METRICS if m != 'earnings')},
               coalesce(nullif(earnings, 0), value) as earnings
        from ({_PIVOT}) p left join (select ticker, value from {_LATEST_VALUE} v
             where label = '{EARNINGS_LINE}') s using (ticker)""",
                           "company_info", "statement_lines"),
    "statement_latest": sql(f"select ticker, label, value from {_LATEST_VALUE} v",
                            "statement_lines"),
    "metrics_pivot": sql(_PIVOT, "company_info"),
    "earnings_fallback": sql(f"""
        select ticker, coalesce(nullif(earnings, 0), value) as earnings
        from ({_PIVOT}) p left join (select ticker, value from {_LATEST_VALUE} v
             where label = '{EARNINGS_LINE}') s using (ticker)""",
                             "company_info", "statement_lines"),
    "latest_per_key": sql(f"""select {ALL_PRICES} from (select *, row_number() over
        (partition by ticker order by date desc) as rn from px) t where rn = 1""", "px"),
    "snapshot_gold": sql("select * from snapshot", "snapshot"),
    "snapshot_from_fact": sql("select * from snapshot", "snapshot"),
    "chart_gold": sql("select * from chart", "chart"),
    "serve_snapshot": sql("select * from served", "served"),
    "serve_chart": sql(f"""select * from served_chart where ticker = '{CHART_TICKER}'
        order by trading_date""", "served_chart"),
    "serve_counts": sql("select ticker, count(*) as record_count from px group by ticker", "px"),
    "snapshot_one_row": sql("select * from records", "records"),
    "watchlist": sql(f"""select ticker, records.ticker is not null as has_record, trading_date,
        company_name, news_title, metric_1 from {_WANTED} left join records using (ticker)""",
                     "records"),
    "snapshot_labels": sql("""select ticker,
        coalesce(nullif(company_name, ''), nullif(ticker, ''), '—') as company_label,
        coalesce(nullif(sector, ''), '—') as sector_label,
        coalesce(nullif(industry, ''), '—') as industry_label from records""", "records"),
    "chart_indicators": sql("""select *, sma_20 as indicator_1, sma_50 as indicator_2,
        sma_100 as indicator_3, sma_200 as indicator_4 from served_chart""", "served_chart"),
    "indicator_empty": sql("select ticker, " + ", ".join(
        f"coalesce(bool_and(sma_{n} = 0), true) as indicator_{i}_empty"
        for i, n in enumerate(SMA_ROWS, 1)) + " from served_chart group by ticker",
        "served_chart"),
    "visible_metrics": sql("select * from visible", "visible"),
    "format_metrics": sql(f"select *, {_METRIC_TEXT} as text from visible", "visible"),
    "candle_direction": sql("""select ticker, trading_date,
        case when close_price >= open_price then 'up' else 'down' end as direction
        from served_chart""", "served_chart"),
    "news_headers": sql(f"""
        select ticker, title as news_title, news_date, {_sentiment('sentiment_score')}
               as sentiment, {_sentiment_text('sentiment_score')} as sentiment_text
        from latest join profiles using (ticker) join scored using (ticker)
        where title <> ''""", "latest", "profiles", "scored"),
}
ORACLES["entity_match_long"] = ORACLES["entity_match"]
ORACLES["lakehouse_snapshot"] = ORACLES["snapshot_gold"]
ORACLES["lakehouse_chart"] = ORACLES["lakehouse_chart_clustered"] = ORACLES["serve_chart"]
ORACLES["lakehouse_update"] = ORACLES["market_and_risk"]
ORACLES["news_scored_retry"] = ORACLES["news_scored_service"]
ORACLES["enrich_asof"] = ORACLES["enrich_asof_split"] = sql(f"""
    select px.*, {", ".join(f"metrics.{_q(m)}" for m in METRICS)}, rates.risk_free_rate
    from px asof left join metrics on px.ticker = metrics.ticker and px.date >= metrics.date
         asof left join rates on px.date >= rates.date""", "px", "metrics", "rates")
ORACLES["required_columns"] = " union all ".join(f"""
    select '{t}' as name, missing, case when missing = '' then (select count(*) from {t}) end as rows
    from (select coalesce(string_agg(c, ', ' order by c), '') as missing
          from (select unnest([{_texts(CHARTED)}]) as c)
          where c not in (select column_name from information_schema.columns
                          where table_name = '{t}'))""" for t in TABLES)
