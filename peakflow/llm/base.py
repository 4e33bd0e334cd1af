"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import os
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import peakflow

from ..session import shared_path
from ..sources.tables import read_table

BATCH_ROWS = 1000


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application.

    Texts are long, so batches for Python take ``BATCH_ROWS`` rows, not the 10,000 of Spark's default.
    """
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if getattr(sc, "_peakflow_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(peakflow.__file__))
    name = os.path.join(sc._temp_dir, "peakflow_code.zip")  # the driver serves it from there while it runs
    with zipfile.ZipFile(name, "w") as z:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(at, f), os.path.relpath(os.path.join(at, f), os.path.dirname(root)))
    sc.addPyFile(name)
    sc._peakflow_shipped = True


def tidy(run):
    """A function for mapInArrow that gives freed memory back to the system when its task ends.

    Python workers live on between tasks, and an executor's memory holds those of all its operators.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            libc = ctypes.util.find_library("c")
            if libc and hasattr(ctypes.CDLL(libc), "malloc_trim"):
                ctypes.CDLL(libc).malloc_trim(0)
    return wrapped


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, text): the two columns alone, a null text as the empty one, and a row number.

    ``rid`` tells repeated rows apart. It depends on the scan's partitions only, so a task
    that is run again after a lost executor gives the same numbers.
    """
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, h: Column, size: int) -> DataFrame:
    """About ``size`` rows, or all if there are fewer: those of the lowest 64-bit hashes ``h``.

    The cut comes from a count, so nothing is sorted and every task keeps its own share. Rows of one hash stay or
    go together; the sample's size is a sum of independent choices, hence within a few square roots of ``size``.
    """
    n = df.count()
    if n <= size:
        return df
    return df.where(h < F.lit(int(size / n * 2.0 ** 64) - (1 << 63)))


def literal_array(values, kind: str) -> Column:
    """An array literal made from one string; the optimizer folds it to a constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
