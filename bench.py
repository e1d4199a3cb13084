"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs after one
warm run of the whole list; the median counts), BENCH_QUERIES (comma-separated names instead of the headline list).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import session  # noqa: E402
from tidemark.plans import load_all  # noqa: E402

HEADLINE = [
    "indicator_table", "outer_merge_series", "latest_and_previous", "trend_cv", "robust_scale", "forecast_bounds",
    "conditional_matrix", "rollup_path", "pivot_mean", "facet_cube", "group_sum_positive", "unpivot_measures",
    "merge_chain", "parent_children", "segment_category_profile", "new_rows_only", "dedup_latest", "chrono_split",
    "cascade_top_k", "top_k_per_measure", "top_words", "keyword_documents", "rank_band_words", "section_extract",
    "html_text", "cosine_top_10", "text_match", "hybrid_search", "recursive_forecast", "stream_append",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session.build("bench", f"local[{cpus}]", None if cpus == "*" else int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    functions, seconds = load_all().functions, {}
    for name in names:
        run(functions[name](spark, folder))
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            run(functions[name](spark, folder))
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
