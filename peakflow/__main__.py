"""Command line: run the movement programs on a Parquet table.

    spark-submit -m peakflow --input flights.parquet --output out/ [--programs preprocess,sql]

The session comes from ``spark-submit`` / ``SparkSession.builder.getOrCreate()``;
on a cluster set ``spark.checkpoint.dir`` to a shared folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.programs import PROGRAMS, run_all
from .session import ensure_checkpoint_dir
from .spec import FLIGHTS


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="peakflow")
    ap.add_argument("--input", required=True, help="Parquet path of the raw movement table")
    ap.add_argument("--output", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--programs", default=",".join(PROGRAMS),
                    help="comma list of: " + ", ".join(PROGRAMS))
    ap.add_argument("--time-zone", default=FLIGHTS.time_zone)
    ap.add_argument("--peak-percentile", type=float, default=FLIGHTS.peak_percentile)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("peakflow").getOrCreate()
    ensure_checkpoint_dir(spark)
    spec = FLIGHTS.with_(time_zone=args.time_zone, peak_percentile=args.peak_percentile)
    run_all(spark, args.input, args.output, spec, tuple(p for p in args.programs.split(",") if p))


if __name__ == "__main__":
    main()
