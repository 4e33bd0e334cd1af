"""Operator 4: token counts through a compiled finite-state transducer.

Texts are cut into chunks of ``CHUNK`` characters; each chunk gives its state map
(see `transducer`), and a document's maps, gathered by a grouped aggregate of small rows,
compose into its count. Nothing but chunk maps is shuffled. The map of a chunk without a
space is the chunk's text; a document that has no space at all is so read whole by one task.

Defined results: a null text is the empty one, which has no tokens; repeated rows are
each counted; the strings of control tokens inside a text are ordinary text, as
the tokenizer has it; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ship_code, texts, tidy
from .transducer import Transducer, scan

CHUNK = 65_536
LIMIT = 4096


@lru_cache(maxsize=2)
def _transducer(name: str) -> Transducer:
    return Transducer(SparkFiles.get(name))


def chunk_maps(docs: DataFrame, model: str, chunk: int = CHUNK) -> DataFrame:
    """(rid, doc_id, n_bytes, seq, head, middle, tail) of each chunk of each text, from `base.texts` columns."""
    spark = docs.sparkSession
    ship_code(spark)
    spark.sparkContext.addFile(model)
    name = model.rsplit("/", 1)[-1]
    spaced = F.concat(F.lit(" "), "text")  # the model puts a space before every text that isn't empty
    parts = docs.select("rid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.posexplode_outer(
        F.when(F.col("text") != "", F.when(F.length("text") < chunk, F.array(spaced)).otherwise(
            F.regexp_extract_all(spaced, F.lit("(?s).{1,%d}" % chunk), F.lit(0))))).alias("seq", "part"))

    def run(batches):
        t = _transducer(name)
        for b in batches:
            maps = [("", None, "") if x is None else t.chunk_map(x) for x in b.column(4).to_pylist()]
            at = [i for i, m in enumerate(maps) if m[1] is not None]
            counts = t.count(pa.array([maps[i][1] for i in at], pa.string()))
            middle: list[int | None] = [None] * len(maps)
            for i, n in zip(at, counts.tolist(), strict=True):
                middle[i] = n
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array([m[0] for m in maps], pa.string()), pa.array(middle, pa.int64()), pa.array([m[2] for m in maps], pa.string())],
                names=["rid", "doc_id", "n_bytes", "seq", "head", "middle", "tail"])

    return parts.mapInArrow(tidy(run), "rid long, doc_id long, n_bytes long, seq int, head string, middle long, tail string")


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row."""
    maps = chunk_maps(texts(docs, id_col, text_col), model, chunk)
    each = maps.groupBy("rid", "doc_id", "n_bytes").agg(F.collect_list(F.struct("seq", "head", "middle", "tail")).alias("maps"))
    name = model.rsplit("/", 1)[-1]

    def run(batches):
        t = _transducer(name)
        for b in batches:
            n = []
            for maps in b.column(3).to_pylist():
                maps.sort(key=lambda m: m["seq"] or 0)
                head, middle, tail = scan([(m["head"], m["middle"], m["tail"]) for m in maps], t.line)
                n.append(t.line(head) + (middle or 0) + t.line(tail))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return each.mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op4(spark: SparkSession, docs: DataFrame, model: str) -> DataFrame:
    return token_counts(docs, model)
