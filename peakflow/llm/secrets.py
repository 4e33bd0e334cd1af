"""Operator 2: secret scans. Fixed patterns, and character Markov models of random strings.

Two models of character pairs, one of random strings and one of ordinary identifiers, are
trained from labelled samples (`train`); the log-likelihood ratio of a run of key characters
under them tells secrets without a known form. In `scan` the labels come from
the corpus itself: what the fixed patterns found is random, words and identifiers of a
bounded sample of texts are ordinary. Built from DataFrame functions alone.

Defined results: a null text is the empty one and has no spans; repeated rows each give a row;
runs that touch a span of a fixed pattern add none; in an empty table, or one without
samples, the smoothed models decide alone; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import hash_sample, literal_array, texts, written
from .spans import matches

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Ordinary strings: words shorter than the runs that are judged.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,19}(?![A-Za-z0-9+/_=-])"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET) + 1  # 0: the start of a string
#: Counts that each pair has before training, random and ordinary.
PRIOR = (4.0, 0.25)
#: Ordinary strings are learnt from the texts of about so many documents at most, random ones from so many distinct matches.
SAMPLE_DOCS, SAMPLE_RANDOM = 4000, 50_000
#: Natural logarithm of the odds against a run's being a secret.
THRESHOLD = 10.0


def _code(c: Column) -> Column:
    return F.instr(F.lit(ALPHABET), c)


def _pair(s: Column, i: Column) -> Column:
    """Index of the character pair that ends at place ``i`` (from 1)."""
    last = F.when(i > 1, _code(s.substr(i - 1, F.lit(1)))).otherwise(F.lit(0))
    return last * SIZE + _code(s.substr(i, F.lit(1)))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios by character pair, from samples (s string, random boolean)."""
    pairs = samples.where(F.length("s") > 0).select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("s")), lambda i: _pair(F.col("s"), i))).alias("pair"))
    counts = [[PRIOR[0]] * SIZE * SIZE, [PRIOR[1]] * SIZE * SIZE]
    for r in pairs.groupBy("random", "pair").count().collect():  # at most 2 * SIZE * SIZE rows
        counts[not r["random"]][r["pair"]] += r["count"]
    logs = []
    for c in counts:
        row = [sum(c[i * SIZE:(i + 1) * SIZE]) for i in range(SIZE)]
        logs.append([math.log(c[i] / row[i // SIZE]) for i in range(SIZE * SIZE)])
    return [a - b for a, b in zip(*logs, strict=True)]


def log_ratio(s: Column, model: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0.0), lambda a, i: a + F.get(model, _pair(s, i)))


def base_spans(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, assign, access, hex, runs): the fixed patterns' matches and the runs that the models judge."""
    t = F.col("text")
    return docs.select("rid", "doc_id", F.filter(matches(t, ASSIGN, 2), lambda m: F.length(m["g2"]) >= 6).alias("assign"),
                       matches(t, ACCESS).alias("access"), matches(t, HEX).alias("hex"), matches(t, RUN).alias("runs"))


def labelled_samples(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(s, random): matches of the fixed patterns as random strings, words of sampled texts outside them as ordinary."""
    strings = (found.select(F.explode(F.concat(F.transform("assign", lambda m: m["g2"]), F.transform("access", lambda m: m["s"]),
                                               F.transform("hex", lambda m: m["s"]))).alias("s")).distinct())
    random = hash_sample(strings, F.xxhash64("s"), SAMPLE_RANDOM)
    words = hash_sample(docs, F.xxhash64("doc_id", "text"), SAMPLE_DOCS).select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("s")).distinct()
    return random.withColumn("random", F.lit(True)).unionByName(words.join(strings, "s", "left_anti").withColumn("random", F.lit(False)))


def _typed(c: str, rank: int) -> Column:
    return F.transform(c, lambda m: F.struct(m["start"], F.lit(rank).alias("rank"), m["end"]))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda m: F.concat_ws(":", F.get(names, m["rank"]), m["start"], m["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(rid, doc_id, base, spans): arrays of (start, rank, end) of the fixed patterns, and with the models' own added.

    ``rank`` is the kind's place in ``KINDS``.
    """
    rows = texts(docs, id_col, text_col)
    found = written(base_spans(rows), "secret-matches")
    model = literal_array([round(x, 6) for x in train(labelled_samples(found, rows))], "double")
    base = found.select("rid", "doc_id", "runs", F.concat(*[_typed(k, i) for i, k in enumerate(KINDS[:3])]).alias("base"))
    new = F.filter("runs", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
                   & (log_ratio(m["s"], model) >= threshold))
    return base.select("rid", "doc_id", "base", F.concat("base", F.transform(new, lambda m: F.struct(
        m["start"], F.lit(3).alias("rank"), m["end"]))).alias("spans"))


def op2(spark: SparkSession, docs: DataFrame) -> DataFrame:
    got = scan(docs)

    def number(rank):
        return F.size(F.filter("base", lambda m: m["rank"] == rank)).cast("long").alias(f"n_{KINDS[rank]}")

    return got.select("doc_id", *map(number, range(3)), F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
