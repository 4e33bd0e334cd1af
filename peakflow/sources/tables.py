"""Table readers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(base: str, name: str) -> str:
    return os.path.join(base, f"{name}.parquet")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan of ``{base}/{name}.parquet``; projections and filters push into it."""
    return spark.read.parquet(table_path(base, name))
