"""Corpus pipeline: the stages that make a training corpus of the documents table.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result
is written as Parquet and read again as the next one's docs.

1. toxicity: documents that the factorization machine scores 0.5 or more go.
2. line_dedup: repeated blocks of lines are cut out of later documents; a document goes if nothing is left of it.
3. near_dedup: of each group of near-duplicates (five words, similarity 0.8) the smallest id stays.
4. decontamination: documents that hold a benchmark item go.
5. bpe: every document's token ids, with digests of them and of the decoded text.

Defined results: null texts are scored as empty ones, and stay; documents without an id stay in near_dedup; rows with
one id stay or go together there; an empty table gives an empty one; other columns of documents are kept up to stage 4.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakflow.llm import bpe, decontam, linededup, neardup
from peakflow.llm import toxicity as tox
from peakflow.llm.base import documents, fresh, written
from peakflow.sources.tables import read_table

TOXIC = 0.5
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = tox.train(docs, read_table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return tox.score(docs, model, score_col=score).where(F.col(score) < TOXIC).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = fresh(docs, "n_deleted")
    out = linededup.dedup_lines(docs, gone_col=gone)
    out = out.where((F.col(gone) == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col(gone) == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = neardup.classes(docs, NEAR_SHINGLE, NEAR_PERCENT)
    copies = groups.where("NOT kept").select(F.col("doc_id").alias(fresh(docs, "copy"))).distinct()
    return docs.join(copies, F.col("doc_id").cast("long") == copies[0], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path("byte_bpe_50k.json"), decoded_col="decoded")
    return both.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source",
                       F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("bpe", encode)]

#: SQL has no factorization machine; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
