"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from formline.plans.catalog import QUERIES
from formline.session import local_session

HEADLINE = [
    "asof_join_strict", "league_rank_team", "league_rank_pitcher", "trailing_avg_team", "trailing_avg_pitcher",
    "latest_by_date", "record_before_game", "assemble_matchup", "dataset_home_win", "build_training_features",
    "flatten_player_stats", "scan_game_json", "unpivot_bookmakers", "pivot_odds_by_book", "merge_home_away_odds",
    "format_odds", "daily_game_number", "scan_csv_prefix", "sink_parquet", "distinct_rows", "result_summary",
    "accuracy_ztest", "metric_log_loss", "naive_forecast_error",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "formline-bench")
    # One small query first, so that no headline number carries the start of the JVM.
    QUERIES["scan_parquet"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
