"""Headline queries, timed. Prints one JSON line.

``rows_per_sec`` divides the rows of the four base tables by a query's seconds.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "ml_feature_matrix", "agg_call_features", "agg_usage_features", "join_asof_latest", "ml_target_encode_fit", "met_all", "win_decile", "met_segment",
    "met_business_impact", "drf_psi_all", "drf_dataset", "surv_km_strata", "dq_gate", "agg_corr_matrix", "scr_format", "sink_features", "surv_cox_fit",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from ebbtide.catalog import QUERIES
    from ebbtide.session import get_session

    spark = get_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus)
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    rows = sum(spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("orders", "lineitem", "events", "customer"))
    times: dict[str, float] = {}
    noop(QUERIES["agg_call_features"](spark, folder))  # warm the session
    for key in HEADLINE:
        taken = []
        for i in range(runs + 1):
            start = time.perf_counter()
            noop(QUERIES[key](spark, folder))
            if i:  # the first run warms code generation and file listings
                taken.append(time.perf_counter() - start)
        times[key] = round(statistics.median(taken), 3)
        print(f"{key}: {times[key]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total_seconds", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name.removeprefix("sf"),
        "cpus": cpus, "shuffle_partitions": cpus, "runs": runs, "input_rows": rows,
        "rows_per_sec": {key: round(rows / seconds) for key, seconds in times.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
