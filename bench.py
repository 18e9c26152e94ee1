"""Seconds per headline query on one machine; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, the best counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.catalog import QUERIES  # noqa: E402
from riskloom.session import get_session  # noqa: E402

HEADLINE = [
    "feature_table", "feature_table_ties", "feature_table_hot", "vel_count", "vel_sum", "hist_std", "since_geo",
    "new_device", "semi_exists", "uid_keys", "join_identity", "join_inner", "join_agg_sort", "agg_where_having",
    "win_avg", "win_rank", "win_rownum", "win_topn", "sort_multi", "time_split", "strat_kfold", "cardinality",
    "null_profile", "onehot", "zscore", "pr_curve", "avg_precision", "split_report", "thr_business", "score_density",
    "score_kde", "decision", "src_csv", "src_record", "early_stop", "prune_median", "gbt_predict", "stream_features",
]
ONCE = {"gbt_predict", "stream_features"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["agg_group_avg"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the engine

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(1 if name in ONCE else runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken), 3)
        print(f"{name:20s} {' '.join(f'{t:.2f}' for t in taken)}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
