"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    runs per query, the median counts (default 1)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "event_response", "epoch_by_events", "sliding_epochs", "segment_windows_samples", "descriptive", "standardise", "baseline_correct",
    "tddr", "reject_gradient", "infer_sfreq_median", "interval_metrics", "welch_spectrum", "band_power", "mean_spectrum", "coherence",
    "filter_signal", "detect_peaks", "plv", "ttest_independent", "mann_whitney", "anova_oneway", "bootstrap_ci_percentile",
    "correlation_spearman", "correlation_kendall", "ols_cell_means", "linreg_grouped", "ridge", "mixed_model_summary", "pivot_long_to_wide",
    "bin_by_labels", "build_tree", "reparent_by_onset", "align_events", "fdr_bh",
]


def main() -> None:
    from sigstat.catalog import QUERIES
    from sigstat.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "bench", "16g")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    run("event_response")  # class loading and code generation of the first query
    run("welch_spectrum")  # first Python workers
    names = sys.argv[1:] or HEADLINE
    took = {n: round(statistics.median(run(n) for _ in range(runs)), 3) for n in names}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
