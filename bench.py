"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit",
"queries": {name: median sec}, "sf", ...}. Each query is run once to warm the
JVM, then timed ``$BENCH_REPEAT`` times (default 3). A timed run builds the
query (including any eager statistics passes) and executes its full plan into
Spark's ``noop`` sink, so the time is execution, not Python row conversion.
"""

from __future__ import annotations

import json
import os
import platform
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mesonlab.plans import QUERIES  # noqa: E402
from mesonlab.session import get_session  # noqa: E402

HEADLINE = [
    "b_mass", "candidate_selection", "row_count", "min_max", "group_by_agg", "describe",
    "summary", "exact_quantile", "approx_quantile", "approx_quantile_001", "fd_binning",
    "bin_assign", "histogram_edges", "histogram_fd", "histogram_fd_all", "histogram_fd_approx",
    "column_histogram", "column_histograms", "sort_take", "column_udf", "udf3_sql", "dataset_map",
]


def run(fn, spark, sf_dir) -> None:
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session("mesonlab-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    timings, errors = {}, {}
    for name in names:
        fn = QUERIES[name]
        try:
            run(fn, spark, sf_dir)                       # warm-up
            runs = []
            for _ in range(repeat):
                t0 = time.perf_counter()
                run(fn, spark, sf_dir)
                runs.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(runs), 4)
        except Exception as exc:                         # report, keep timing the rest
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "repeat": repeat,
        "host": {"cores": os.cpu_count(), "python": platform.python_version()},
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
