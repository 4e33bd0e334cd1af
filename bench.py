"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to restrict), BENCH_ML=0 to skip the forest fit.

Each query is executed in full into the ``noop`` sink (every row produced, no
collect), once to warm up and then BENCH_RUNS times; the forest BENCH_ML_RUNS times (default 3)
after a warm-up. Plans are kept between runs, so the time of building each one first is
given apart, as first_plan_building_sec. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "preprocess",
    "missing_compare",
    "invalid_format_counts",
    "iqr_outliers",
    "duplicate_report",
    "busiest_windows",
    "sql_rolling_avg",
    "sql_hourly_surge",
    "sql_peak_share",
    "sql_top_dest_per_carrier",
    "sql_grouping_sets",
    "sql_percentile_tier",
    "sql_avg_by_daytype",
    "sql_top_dest_dense",
    "top_carriers",
    "avg_by_daytype",
    "top_routes",
    "distinct_routes",
    "ml_features",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    ml_runs = int(os.environ.get("BENCH_ML_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from peakflow.plans.registry import all_queries
    from peakflow.session import local_session

    scratch = tempfile.mkdtemp(prefix="peakflow-bench-")  # a bench runs on one machine
    spark = local_session(cpus, shuffle_partitions=cpus, extra={
        "spark.checkpoint.dir": f"file://{scratch}/shared", "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    queries = all_queries()
    names = only or HEADLINE
    timings, building = {}, 0.0
    for name in names:
        t0 = time.perf_counter()
        df = queries[name](spark, sf_dir)
        building += time.perf_counter() - t0
        run_noop(df)  # warm-up (JIT, file listing, codegen caches)
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            run_noop(queries[name](spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)

    if os.environ.get("BENCH_ML", "1") != "0" and not only:
        from peakflow.operators import ml
        from peakflow.plans.ml_queries import KEY, ml_input
        from peakflow.sources.bindings import MOVEMENTS
        train, test = ml.hash_split(ml_input(spark, sf_dir), KEY)
        samples = []
        for _ in range(1 + ml_runs):  # the first is the warm-up
            t0 = time.perf_counter()
            model = ml.model_pipeline(train, MOVEMENTS).fit(train)
            run_noop(ml.classification_metrics(model.transform(test)))
            samples.append(time.perf_counter() - t0)
        timings["ml_random_forest_fit_eval"] = round(statistics.median(samples[1:]), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "ml_runs": ml_runs,
        "first_plan_building_sec": round(building, 3),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
