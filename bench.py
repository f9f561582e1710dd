"""Time the headline queries; prints one JSON line.

Each query runs to the end into a sink that discards the rows; the best of ``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medallion.session import build_session  # noqa: E402
from workload import load  # noqa: E402

HEADLINE = [
    "etl_job", "derive_chain", "iqr_fences", "outlier_clamp", "outlier_median", "outlier_neighbor", "flatten_documents",
    "explode_documents", "json_decode", "csv_roundtrip", "parquet_modes", "split_exact", "impute_median", "impute_mode",
    "standardize", "linreg_single", "rf_regress", "score_udf", "errors_regression", "class_quality", "auc", "best_by_name",
    "train_run", "inference_run", "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load()[0]
    names = os.environ["BENCH_ONLY"].split(",") if os.environ.get("BENCH_ONLY") else HEADLINE
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
