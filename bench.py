"""Times the headline queries and prints one JSON line.

Every query runs start to end (scan, stages, fit) into a sink that discards the
rows; the figure is the better of two runs.
"""

from __future__ import annotations

import json
import os
import time

from tallyrec.plans.catalog import all_queries
from tallyrec.session import build_session

HEADLINE = (
    "interaction_counts_orders",
    "activity_profile_orders",
    "split_sizes",
    "popularity_report",
    "damped_vote_top100",
    "ranking_metrics_at_k",
    "beta_sweep_orders",
    "split_stability",
    "size_sweep_popularity",
    "encoded_interaction_counts",
    "als_top100",
    "als_scores",
    "exact_topk_search",
    "lsh_topk_search",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tallyrec-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.monotonic()
            all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.monotonic() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
