"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores, BENCH_RUNS
the timed runs per query after one warm-up; the median counts. Every result is computed in full.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillframe.registry import load_catalog  # noqa: E402
from quillframe.session import build_session  # noqa: E402

HEADLINE = [
    "flagship_daily_activity", "S04_tsv_load", "P08_expression_string", "M05_forward_fill", "J13_star_join",
    "J15_bracket_join", "J16_nearest_l2", "A05_describe_grouped", "A15_margins", "A26_daily_requests", "A28_class_histogram",
    "W01_average_rank", "W12_running", "W16_runs", "O07_k_smallest_per_group", "U06_set_algebra", "F18_clean_sentence",
    "T05_upsample_ffill", "D05_running_total", "Q03_cdf_percentiles", "Q04_compare", "Q19_correlation", "Q23_permutation_test",
    "L11_logistic_regression", "L26_auc", "C02_vocabulary", "C04_skip_grams", "C09_tf_idf",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    catalog, times = load_catalog(), {}
    for name in HEADLINE:
        seen = []
        for _ in range(runs + 1):
            t0 = time.perf_counter()
            catalog[name](spark, path).write.format("noop").mode("overwrite").save()
            seen.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(seen[1:]), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(path.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
