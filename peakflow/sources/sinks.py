"""Distributed sinks. Every writer runs in parallel on the executors; nothing
is gathered in one task, and a single output file is opt-in only."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import UnsupportedOperationException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import qcol
from ..spec import TIME_ZONE


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              single_file: bool = False, time_zone: str = TIME_ZONE) -> str:
    """CSV with a header; instants are written in ``time_zone``.

    ``single_file`` writes the parts in parallel, without headers, and joins them to one file (:func:`_joined`).
    """
    if single_file:
        return _joined(df, path, header, mode, time_zone)
    df.write.mode(mode).option("header", header).option("timeZone", time_zone).csv(path)
    return path


def _joined(df: DataFrame, path: str, header: bool, mode: str, time_zone: str) -> str:
    """One CSV file in the folder ``path``: parts written by all tasks, put together by the file system's own ``concat``.

    A file system that has none (local ones, object stores) gets them copied one after another, in small buffers.
    """
    spark = df.sparkSession
    jvm, conf, mark = spark._jvm, spark._jsc.hadoopConfiguration(), uuid.uuid4().hex[:12]
    at = jvm.org.apache.hadoop.fs.Path
    folder, scratch = at(path), f"{path.rstrip('/')}_parts-{mark}"
    fs = folder.getFileSystem(conf)
    if fs.exists(folder):
        if mode == "ignore":
            return path
        if mode in ("error", "errorifexists"):
            raise FileExistsError(path)
    names = [] if not header else [spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns)))).coalesce(1)]
    for i, part in enumerate([*names, df]):
        part.write.option("timeZone", time_zone).csv(f"{scratch}/{i}")
    parts = [f.getPath() for i in range(len(names) + 1) for f in sorted(fs.listStatus(at(f"{scratch}/{i}")), key=lambda f: f.getPath().getName())
             if f.getPath().getName().startswith("part-") and f.getLen() > 0]
    if mode == "overwrite":
        fs.delete(folder, True)
    fs.mkdirs(folder)
    whole = at(folder, f"part-00000-{mark}.csv")
    if parts:
        rest = spark.sparkContext._gateway.new_array(at, len(parts) - 1)
        for i, p in enumerate(parts[1:]):
            rest[i] = p
        try:
            if len(parts) > 1:
                fs.concat(parts[0], rest)
            fs.rename(parts[0], whole)
        except UnsupportedOperationException:
            out = fs.create(whole)
            for p in parts:
                one = fs.open(p)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(one, out, conf, False)
                one.close()
            out.close()
    else:
        fs.create(whole).close()
    fs.delete(at(scratch), True)
    fs.create(at(folder, "_SUCCESS")).close()
    return path


def flatten_arrays(df: DataFrame, sep: str = ",") -> DataFrame:
    """Array columns -> ``sep``-joined strings named with dots replaced by underscores."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.concat_ws(sep, qcol(f.name)).alias(f.name.replace(".", "_")))
        else:
            cols.append(qcol(f.name))
    return df.select(*cols)


QUOTED_CSV_OPTIONS = {
    "header": True,
    "quoteAll": True,          # every field quoted
    "escape": '"',             # a quote inside a field is doubled
    "nullValue": "",           # NULL -> ""
    "emptyValue": "",          # '' -> ""
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite", time_zone: str = TIME_ZONE) -> str:
    """Fully quoted CSV (arrays flattened first, instants in ``time_zone``), written in parallel."""
    flatten_arrays(df).write.mode(mode).options(**QUOTED_CSV_OPTIONS, timeZone=time_zone).csv(path)
    return path


def long_form(results: Mapping[str, DataFrame]) -> DataFrame:
    """One row per result row: ``query_name``, ``row_no`` and ``col=value | col=value`` (NULL -> empty).

    Results are answers of a few rows; ``row_no`` keeps their order.
    """
    frames = []
    for name, df in results.items():
        parts = [F.concat(F.lit(f"{c}="), F.coalesce(qcol(c).cast("string"), F.lit(""))) for c in df.columns]
        numbered = df.withColumn("__at", F.monotonically_increasing_id())
        row_no = F.row_number().over(Window.orderBy("__at")).cast("bigint")
        frames.append(numbered.select(F.lit(name).alias("query_name"), row_no.alias("row_no"), F.concat_ws(" | ", *parts).alias("result")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_long_form(results: Mapping[str, DataFrame], path: str, mode: str = "overwrite") -> str:
    long_form(results).write.mode(mode).options(**QUOTED_CSV_OPTIONS).csv(path)
    return path


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> str:
    """(metric, value) table as CSV with a header."""
    metrics.write.mode(mode).option("header", True).csv(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path
