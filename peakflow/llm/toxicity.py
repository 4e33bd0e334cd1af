"""Operator 5: toxicity by a factorization machine over hashed terms.

Terms are the distinct word beginnings of a text (``PREFIXES`` letters, so that inflected forms
share terms), hashed in Spark. The machine's score is a bias, a weight per term and
the inner product of two terms' factors for each pair of terms, which learns that an insult
next to a group's name counts more than both alone. It is fitted on a bounded sample
of labelled rows in one task (AdaGrad) and holds all terms of ``MIN_TEXTS`` texts or more, also those that tell nothing
alone; weights start at smoothed log-odds, drawn to 0 by how little a term's labels differ from the mean, and rare
terms learn in small steps; scoring is a narrow pass over all texts.

Defined results: a null text is the empty one, which scores the bias; a document with
several labels is toxic if one says so, and one with several rows is learnt from the row of the least text hash; null labels and null ids train nothing; without
labels every score is 0; repeated rows each get the same score; an empty table gives an empty
one; `score` keeps all other columns.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import fresh, hash_sample, ship_code, tidy

PREFIXES = (4, 6)
BITS = 22
FACTORS = 4
#: The most labelled rows (but for the spread of a sample by hashes) that the model is fitted on.
SAMPLE_ROWS = 16_000
#: These and the settings below were picked by four-fold cross-validation (log-loss) within the labelled rows of sf0.1 that aren't
#: held out, among those that learn a pair of terms of which neither tells anything alone.
#: A term is kept if so many sampled texts hold it; its weight starts at 0 if its share of toxic ones is less than so many deviations off the mean.
MIN_TEXTS, DEVIATIONS = 3, 3.0
#: Where AdaGrad's sums of squares start, for weights and factors: the larger, the smaller a rare term's steps.
START, FACTOR_START = 0.1, 0.1
#: Texts by which a term's share of toxic ones is drawn to the mean in its first weight.
PRIOR = 2.0
BATCH, RATE, FACTOR_RATE, DECAY, FACTOR_DECAY = 64, 0.1, 0.05, 1e-5, 1e-4
#: Passes over the sample; more where they would be fewer steps than this.
EPOCHS, STEPS = 8, 400


def terms(text: Column) -> Column:
    """The distinct hashed terms of a text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0)))
    hashed = [F.transform(words, _hasher(n)) for n in PREFIXES]
    return F.array_distinct(F.concat(*hashed))


def _hasher(n: int):
    return lambda w: F.pmod(F.xxhash64(F.lit(n), F.substring(w, 1, n)), F.lit(1 << BITS)).cast("int")


class Machine:
    """Factorization machine over a sorted array of known terms; row 0 of the weights is for unknown ones."""

    def __init__(self, known: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray):
        self.known, self.bias, self.w, self.v = known, bias, w, v

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, known=self.known, bias=self.bias, w=self.w, v=self.v)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Machine:
        z = np.load(io.BytesIO(raw))
        return cls(z["known"], float(z["bias"]), z["w"], z["v"])

    def rows(self, hashed: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashed), len(self.known) - 1)
        return np.where(self.known[at] == hashed, at + 1, 0)

    def margins(self, rows: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds and factor sums of texts whose terms are rows[cuts[i] : cuts[i + 1]]."""
        v = self.v[rows]
        s = _sums(v, cuts)
        return self.bias + _sums(self.w[rows], cuts) + 0.5 * (np.square(s) - _sums(np.square(v), cuts)).sum(axis=1), s

    def score(self, hashed: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        rows = self.rows(hashed)
        keep = rows > 0  # unknown terms add nothing
        kept = np.concatenate([[0], np.cumsum(keep)])[cuts]
        return _sigmoid(self.margins(rows[keep], kept)[0])


def _sums(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of x[cuts[i] : cuts[i + 1]], empty ones too."""
    total = np.concatenate([np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)])
    return total[cuts[1:]] - total[cuts[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logit(p):
    return np.log(p / (1 - p))


def fit(hashed: np.ndarray, cuts: np.ndarray, y: np.ndarray, seed: int = 7) -> Machine:
    """Fit a machine to texts whose terms are hashed[cuts[i] : cuts[i + 1]] and their labels 0 or 1."""
    mean = (y.sum() + 0.5) / (len(y) + 1)
    size = int(hashed.max(initial=-1)) + 1
    count, toxic, bad = np.zeros(size), np.zeros(size), np.repeat(y > 0, np.diff(cuts))
    parts = [slice(at, at + (1 << 20)) for at in range(0, len(hashed), 1 << 20)]
    for p in parts:
        count += np.bincount(hashed[p], minlength=size)
        toxic += np.bincount(hashed[p][bad[p]], minlength=size)
    off = (toxic - count * mean) / np.sqrt(np.maximum(count * mean * (1 - mean), 1e-9))
    known = np.flatnonzero(count >= MIN_TEXTS)
    share = (toxic[known] + PRIOR * mean) / (count[known] + PRIOR)
    first = 0.5 * (_logit(share) - _logit(mean)) * np.maximum(0, 1 - np.square(DEVIATIONS / np.maximum(np.abs(off[known]), 1e-9)))
    rnd = np.random.default_rng(seed)
    m = Machine(known, float(_logit(mean)), np.concatenate([[0], first]), rnd.normal(0, 0.01, (len(known) + 1, FACTORS)))
    m.v[0] = 0
    told = np.zeros(len(count), bool)
    told[known] = True
    # The rarest terms go before anything else is made of them.
    keep = np.concatenate([np.zeros(0, bool), *(told[hashed[p]] for p in parts)])
    cuts, rows = np.concatenate([[0], np.cumsum(keep)])[cuts], m.rows(hashed[keep])
    gw, gv, gb = np.full(len(m.w), START), np.full(m.v.shape, FACTOR_START), 1e-6
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(1, len(y))))):
        order = rnd.permutation(len(y))
        for at in range(0, len(y), BATCH):
            docs = order[at:at + BATCH]
            size = cuts[docs + 1] - cuts[docs]
            own = np.concatenate([[0], np.cumsum(size)])
            r = rows[np.repeat(cuts[docs] - own[:-1], size) + np.arange(own[-1])]
            margin, s = m.margins(r, own)
            err = (_sigmoid(margin) - y[docs]) / len(docs)
            used, inv = np.unique(r, return_inverse=True)
            e = np.repeat(err, size)
            g = np.bincount(inv, e, len(used)) + DECAY * m.w[used]
            gw[used] += g * g
            m.w[used] -= RATE / np.sqrt(gw[used]) * g
            sums, v = np.repeat(s, size, axis=0), m.v[r]
            for f in range(FACTORS):
                g = np.bincount(inv, e * (sums[:, f] - v[:, f]), len(used)) + FACTOR_DECAY * m.v[used, f]
                gv[used, f] += g * g
                m.v[used, f] -= FACTOR_RATE / np.sqrt(gv[used, f]) * g
            gb += err.sum() ** 2
            m.bias -= RATE / np.sqrt(gb) * err.sum()
    m.v[0] = 0
    m.w[0] = 0
    return m


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> bytes | None:
    """A fitted machine from the labelled rows that aren't held out, about ``sample_rows`` of them at most."""
    ship_code(docs.sparkSession)
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = hash_sample(y, F.xxhash64("doc_id"), sample_rows)
    labelled = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
                .join(F.broadcast(sample), "doc_id"))  # about sample_rows ids at most
    # One row for each id, however often it repeats: that of the least text hash. Partial aggregates go to the shuffle.
    single = labelled.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = single.select("doc_id", "toxic", terms(F.col("text")).alias("terms")).repartition(1).sortWithinPartitions("doc_id").select("toxic", "terms")

    def run(batches):
        y, hashed, sizes = [], [], []
        for b in batches:
            y.append(np.asarray(b.column(0)))
            hashed.append(np.asarray(b.column(1).flatten()))
            sizes.append(np.diff(np.asarray(b.column(1).offsets)))
        if y:
            cuts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            raw = fit(np.concatenate(hashed), cuts, (np.concatenate(y) > 0).astype(float)).dump()
            yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["model"])

    got = rows.mapInArrow(tidy(run), "model binary").collect()  # one row
    return bytes(got[0][0]) if got else None


def score(docs: DataFrame, model: bytes | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability that each text is toxic."""
    if model is None:
        return docs.withColumn(score_col, F.lit(0.0))
    ship_code(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # the terms of a bounded sample
    kept = [c for c in docs.columns if c != score_col]
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches):
        machine = None
        for b in batches:
            machine = machine or Machine.load(sent.value)
            t = b.column(b.num_columns - 1)
            cuts = np.asarray(t.offsets)
            p = machine.score(np.asarray(t.flatten()), cuts - cuts[0])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p)], names=[*kept, score_col])

    return docs.select(*kept, terms(F.col(text_col)).alias(fresh(docs, "terms"))).mapInArrow(tidy(run), schema)


def op5(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    got = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).drop("text")
    return got.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
