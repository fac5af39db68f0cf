"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.checks.queries import QUERIES
from tidemark.session import local_session

HEADLINE = (
    "prices_union_dedup", "metrics_clean", "join_snapshots", "enrich_market", "sma", "returns",
    "rolling_moments", "sharpe_252", "var_95", "ratios", "market_and_risk",
    "market_and_risk_split", "sma_split", "ticks_hot_key", "news_top3", "news_scored",
    "news_to_json", "news_scored_service", "entity_match", "sentiment_label", "extract_html",
    "statement_latest", "metrics_pivot", "latest_per_key", "snapshot_gold",
    "snapshot_from_fact", "chart_gold", "serve_snapshot", "serve_chart", "format_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, "bench", **{
        "spark.sql.shuffle.partitions": cores, "spark.driver.memory": "16g"})
    QUERIES["chart_gold"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cores": int(cores),
    }))


if __name__ == "__main__":
    main()
