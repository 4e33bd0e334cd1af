"""Operator 9: sharding by extendible hashing.

Every row's bits are the first ones of a hash of its id and text, as many as the first
histogram has, then those of a hash of its row number, which part rows that are equal in both. A directory is indexed by the first bits; a bucket that holds more
than the byte limit is split on its next bit, and no other bucket is. The splits are found
from one histogram of cells, a few bits deeper than the mean shard needs, whose sums roll
up to every shorter prefix; only rows of cells that still are too large (many equal rows)
go into another round, on their further bits. A shard is the shortest prefix that fits.

Defined results: a null text has 0 bytes; a null id hashes as a value of its own; repeated rows
are kept apart by their row numbers; a row that alone exceeds the limit gets a shard of
its own, marked ``oversize``; an empty table has no shards; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import texts, written

LIMIT = 32 << 20
#: Bits of the histogram beyond those of a mean shard, and the most in one round.
SLACK, MOST = 3, 40


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")


def _bits(node: Column, depth: Column) -> Column:
    """A prefix as a string of bits."""
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.conv(node.cast("string"), 10, 2), depth, "0"))


def _directory(cells: DataFrame, bits: int, limit: int) -> DataFrame:
    """(base, cell, shard, depth, shard_bytes, shard_docs): the bucket of each slot of the directory.

    ``base`` is the bits that earlier rounds split on. The bucket is the shortest prefix that
    fits the limit or holds one row; cells that are still too large have no bucket.
    """
    up = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")).withColumn(
        "node", F.expr(f"shiftright(cell, {bits} - depth)"))
    sums = (up.groupBy("base", "depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
            .where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)))
    best = (up.select("base", "cell", "depth", "node").join(sums, ["base", "depth", "node"])
            .groupBy("base", "cell").agg(F.min(F.struct("depth", "node", "shard_bytes", "shard_docs")).alias("b")))
    return best.select("base", "cell", F.concat("base", _bits(F.col("b.node"), F.col("b.depth"))).alias("shard"),
                       "b.shard_bytes", "b.shard_docs")


def assign(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, n_bytes, shard, depth, shard_bytes, shard_docs, oversize) of each row."""
    rows = written(texts(docs, id_col, text_col).select(
        "rid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("doc_id", "text").alias("h"),
        F.xxhash64("rid").alias("more"), F.lit("").alias("base")), "shard-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    done, h, used = [], "h", 0
    while True:
        bits = min(MOST, 64 - used, max(1, math.ceil(math.log2(max(total, 1) / limit)) if total > limit else 0) + SLACK)
        cell = _prefix(F.shiftleft(F.col(h), used), bits)
        rows = rows.withColumn("cell", cell)
        cells = rows.groupBy("base", "cell").agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
        slots = _directory(cells, bits, limit)
        placed = written(rows.join(slots, ["base", "cell"], "left"), "shard-placed")
        done.append(placed.where(F.col("shard").isNotNull()))
        rest = placed.where(F.col("shard").isNull())
        # The largest cell decides how many bits more its rows need.
        total = rest.groupBy("base", "cell").agg(F.sum("n_bytes").alias("b")).agg(F.max("b")).first()[0]
        if total is None:
            break
        used = used + bits if h == "more" else 0
        rows = written(rest.select("rid", "doc_id", "n_bytes", "h", "more", F.concat("base", _bits(F.col("cell"), F.lit(bits))).alias("base")), "shard-rows")
        h = "more"
        if used == 64:  # row numbers of one hash: each of these rows gets a shard of its own
            own = F.concat("base", _bits(F.col("rid"), F.lit(63)))
            done.append(rows.select("rid", "doc_id", "n_bytes", own.alias("shard"), F.col("n_bytes").alias("shard_bytes"), F.lit(1).cast("long").alias("shard_docs")))
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out.select("rid", "doc_id", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", "shard_docs",
                      (F.col("n_bytes") > limit).alias("oversize"))


def write_shards(docs: DataFrame, folder: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every row's id and text as Parquet under ``folder``, a folder for each shard; returns the assignment."""
    where = assign(docs, limit, id_col, text_col)
    full = texts(docs, id_col, text_col).drop("doc_id").join(where, "rid")
    full.select("doc_id", "text", F.concat(F.lit("b"), "shard").alias("shard")).repartition("shard").write.partitionBy("shard").parquet(folder)
    return where


def op9(spark: SparkSession, docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    return assign(docs, limit).drop("rid")
