"""Operator 13: hard-negative mining by LEMP-style coordinate pruning.

Vectors become integers, floor(256 * x). The rows of a label lie in length buckets: lengths of one bucket differ by an
eighth of a doubling at most, and a bucket holds about ``BUCKET`` rows. A bucket keeps each coordinate of its unit vectors
as a sorted list. An anchor that wants scores of t or more can only find them at angles within
arccos(t / (its length * the bucket's length)); a bucket where that is beyond 1 is skipped, and otherwise the angle bounds the
values of the anchor's ``FOCUS`` largest coordinates. The sorted lists give the rows in the narrowest of these ranges, the other
ranges are intersected with it, and only what is left is verified by exact inner products.

Anchors go in blocks. A block first visits one bucket, for a first bound of its k-th scores; pairs of block and bucket that
this bound rules out are dropped before any vector is sent to a bucket. A task holds one bucket and reads the blocks that
come to it one after another, so candidates are shuffled once and not copied for each block. Positives come first (buckets of the
anchor's label), then negatives (buckets of other labels), whose scores must lie in a window below each positive's score.

Defined results: rows with a null id, label or vector, or a null or non-finite component, take no part; vectors are compared with
those of their own length (empty ones score 0); repeated rows are candidates of each other, as only the anchor's
own row is left out, and repeated anchors each have their own rows; ties go to the smaller id; anchors
without positives, and positives without negatives in their window, give no rows; components and scores
beyond the range of long are held at its ends; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import ship_code, tidy, written

K = 5
#: Percent of the positive's score from which on a row is a hard negative.
LEAST = 80
#: Rows of a length bucket, anchors of a block, steps of length to a doubling, and coordinates that are intersected.
BUCKET, BLOCK, STEPS, FOCUS = 4096, 128, 8, 4
LONG = 1 << 63
#: Rounding of angles, as a share of their range.
SLACK = 1e-9


def labelled_integers(vectors: DataFrame, label: Column, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(rid, vec_id, label, v array<long>, len) of the rows that take part; ``label`` is an expression over the id and label columns."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"), good.alias("good"))
    v = F.transform("x", lambda c: F.floor(F.lit(256.0) * c).cast("long"))
    return rows.where("good AND vec_id IS NOT NULL AND label IS NOT NULL").select("rid", "vec_id", "label", v.alias("v")).withColumn(
        "len", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))


def _bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with (dim, step, part), which with the label name their bucket."""
    step = F.when(F.col("len") > 0, F.floor(F.lit(float(STEPS)) * F.log2("len"))).otherwise(-1).cast("int")
    known = rows.withColumns({"dim": F.size("v"), "step": step})
    keys = ["dim", "label", "step"]
    sizes = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / BUCKET))
    return known.join(sizes.select(*keys, "parts"), keys).withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")).drop("parts")


BUCKET_KEY = ["dim", "label", "step", "part"]


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of one integer vector with the rows of c, held at the ends of long."""
    most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (q, c)]
    if most[0] * most[1] * max(1, len(q)) < 2.0 ** 52:
        return (c.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return np.array([max(-LONG, min(LONG - 1, sum(int(a) * int(b) for a, b in zip(q, row, strict=True)))) for row in c], dtype=np.int64)


class Lists:
    """A bucket: its rows, and a sorted list of each coordinate of their unit vectors."""

    def __init__(self, rid: np.ndarray, vec_id: np.ndarray, v: np.ndarray):
        self.rid, self.vec_id, self.v = rid, vec_id, v
        x = v.astype(np.float64)
        length = np.sqrt(np.square(x).sum(axis=1))
        self.longest, self.shortest = (float(f(length, initial=i)) for f, i in ((np.max, 0), (np.min, math.inf)))
        self.unit = x / np.where(length > 0, length, 1)[:, None]
        self.order: dict[int, np.ndarray] = {}
        self.sorted: dict[int, np.ndarray] = {}

    def listed(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.order:
            self.order[f] = np.argsort(self.unit[:, f], kind="stable")
            self.sorted[f] = self.unit[self.order[f], f]
        return self.order[f], self.sorted[f]

    def candidates(self, q: np.ndarray, least: int) -> np.ndarray:
        """Rows whose inner product with q may be ``least`` or more; none is missed."""
        everything, x = np.arange(len(self.rid)), q.astype(np.float64)
        length = float(np.sqrt(np.square(x).sum()))
        reach = length * (self.longest if least > 0 else self.shortest)
        if least > 0 and least > reach * (1 + SLACK):
            return everything[:0]
        if reach == 0 or least <= -reach:
            return everything
        angle = math.acos(max(-1.0, min(1.0, least / reach))) + SLACK * 100
        u = x / length
        focus = np.argsort(-np.abs(u), kind="stable")[:FOCUS]
        own = np.arccos(np.clip(u[focus], -1, 1))
        low = np.cos(np.minimum(np.pi, own + angle)) - SLACK
        high = np.cos(np.maximum(0, own - angle)) + SLACK
        ranges = [(np.searchsorted(s, a), np.searchsorted(s, b, "right")) for (_, s), a, b in zip((self.listed(f) for f in focus), low, high, strict=True)]
        best = int(np.argmin([b - a for a, b in ranges]))
        found = self.listed(focus[best])[0][slice(*ranges[best])]
        for i, f in enumerate(focus):
            if i != best:
                z = self.unit[found, f]
                found = found[(z >= low[i]) & (z <= high[i])]
        return found


#: An anchor's wish: the first k rows of scores from low to high.
WISH = "array<struct<goal: long, low: long, high: long>>"


def _visit(bucket: Lists, anchor_rid: int, q: np.ndarray, wishes: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
    """(goal, row, score) of the first k rows of the bucket for each wish."""
    found = bucket.candidates(q, min(low for _, low, _ in wishes))
    found = found[bucket.rid[found] != anchor_rid]
    if not len(found):
        return []
    scores = products(q, bucket.v[found])
    order = np.lexsort((bucket.rid[found], bucket.vec_id[found], -scores))
    found, scores = found[order], scores[order]
    out = []
    for goal, low, high in wishes:
        a, b = np.searchsorted(-scores, -high), np.searchsorted(-scores, -low, "right")
        out += [(goal, int(found[i]), int(scores[i])) for i in range(a, min(b, a + k))]
    return out


def _search(buckets: DataFrame, pairs: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(anchor_rid, goal, rid, vec_id, score): the first k of every bucket for each wish; ``pairs`` says which block visits which bucket."""
    sent = pairs.join(blocks.select("block", "anchors"), "block").select(
        *BUCKET_KEY, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("rid"), F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<long>").alias("v"), "anchors")
    held = buckets.join(pairs.select(*BUCKET_KEY).distinct(), BUCKET_KEY, "left_semi").select(
        *BUCKET_KEY, F.lit(0).alias("kind"), "rid", "vec_id", "v", F.lit(None).cast(sent.schema["anchors"].dataType).alias("anchors"))

    def run(batches):
        key, rows, bucket = None, [], None
        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(4)), strict=True))
            kind, at = np.asarray(b.column(4)), 0
            while at < b.num_rows:
                end = at + 1
                while end < b.num_rows and keys[end] == keys[at] and kind[end] == kind[at]:
                    end += 1
                if keys[at] != key:
                    key, rows, bucket = keys[at], [], None
                if kind[at] == 0:
                    rows.append(tuple(b.column(i).slice(at, end - at) for i in (5, 6, 7)))
                else:
                    if bucket is None:
                        rid, vec_id = (np.concatenate([np.asarray(r[i]) for r in rows]) for i in (0, 1))
                        v = np.concatenate([np.asarray(r[2].flatten(), dtype=np.int64) for r in rows])
                        bucket, rows = Lists(rid, vec_id, v.reshape(len(rid), key[0])), []
                    for i in range(at, end):
                        out = []
                        for a in b.column(8)[i].as_py():
                            q = np.array(a["v"], dtype=np.int64)
                            out += [(a["rid"], *x) for x in _visit(bucket, a["rid"], q, [(w["goal"], w["low"], w["high"]) for w in a["wishes"]], k)]
                        rid, goal, row, score = (np.array(x, dtype=np.int64) for x in (zip(*out, strict=True) if out else ([],) * 4))
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rid, goal, bucket.rid[row], bucket.vec_id[row], score)],
                                                         names=["anchor_rid", "goal", "rid", "vec_id", "score"])
                at = end

    dealt = held.unionByName(sent).repartition(*BUCKET_KEY).sortWithinPartitions(*BUCKET_KEY, "kind")
    best = dealt.mapInArrow(tidy(run), "anchor_rid long, goal long, rid long, vec_id long, score long")
    order = Window.partitionBy("anchor_rid", "goal").orderBy(F.desc("score"), "vec_id", "rid")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocked(anchors: DataFrame) -> DataFrame:
    """Anchors (rid, label, v, len, wishes) in blocks of one label and vector length, with the weakest score a unit of length that a block asks for."""
    n = anchors.count()
    asked = F.array_min(F.transform("wishes", lambda w: w["low"]))
    least = F.when(F.col("len") > 0, asked / F.col("len")).otherwise(F.when(asked > 0, float("inf")).otherwise(float("-inf")))
    dealt = anchors.select(F.size("v").alias("dim"), "label", F.pmod(F.xxhash64(F.lit(1), "rid"), F.lit(max(1, math.ceil(n / BLOCK)))).alias("deal"),
                           least.alias("least"), F.struct("rid", "v", "wishes").alias("anchor"))
    return written(dealt.groupBy("dim", "label", "deal").agg(F.min("least").alias("least"), F.collect_list("anchor").alias("anchors"))
                   .select(F.struct("dim", "label", "deal").alias("block"), "dim", F.col("label").alias("own"), "least", "anchors"), "negative-anchors")


def _pairs(blocks: DataFrame, metas: DataFrame, same_label: bool, first_only: bool) -> DataFrame:
    """(block, bucket key) of the pairs that lengths don't rule out, or of one bucket for each block.

    Buckets are copied to the deals of the blocks, so that no deal of a label holds all pairs.
    """
    deals = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = F.pmod(F.xxhash64("block"), F.lit(deals)).alias("deal")
    small = blocks.select("block", "dim", "own", "least", deal)
    copied = metas.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    if first_only:
        return _first_pairs(small, metas, same_label)
    on = ["dim", "deal"]
    if same_label:
        small, on = small.withColumn("label", F.col("own")), ["dim", "deal", "label"]
    both = small.join(copied, on)
    if not same_label:
        both = both.where(F.col("own") != F.col("label"))
    reach = F.when(F.col("least") > 0, F.col("longest")).otherwise(float("inf"))
    return both.where(F.col("least") <= reach * (1 + SLACK)).select("block", *BUCKET_KEY)


def _first_pairs(blocks: DataFrame, metas: DataFrame, same_label: bool) -> DataFrame:
    """One bucket for each block: of its own label, or of the next label that its vector length has (after the last, the first)."""
    by_label = Window.partitionBy("dim", "label")
    number = F.row_number().over(by_label.orderBy("step", "part")) - 1
    numbered = metas.withColumns({"number": number, "of": F.count(F.lit(1)).over(by_label)})
    labels = metas.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("of"))
    if not same_label:
        by_dim = Window.partitionBy("dim").orderBy("label")
        around = Window.partitionBy("dim").orderBy("label").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        labels = labels.select("dim", F.col("label").alias("own"), F.coalesce(F.lead("label").over(by_dim), F.first("label").over(around)).alias("label"))
        labels = labels.where("label <> own").join(metas.groupBy("dim", "label").agg(F.count(F.lit(1)).alias("of")), ["dim", "label"])
    else:
        labels = labels.withColumn("own", F.col("label"))
    chosen = blocks.join(labels, ["dim", "own"]).withColumn("number", F.pmod(F.xxhash64("block", F.lit(2)), F.col("of")).cast("int")).drop("of")
    return chosen.join(numbered.drop("of"), ["dim", "label", "number"]).select("block", *BUCKET_KEY)


def _seeded(anchors: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``anchors`` whose wishes begin at the k-th score that a first bucket had for them."""
    kth = found.where(F.col("rank") == k).groupBy("anchor_rid").agg(F.map_from_entries(F.collect_list(F.struct("goal", "score"))).alias("kth"))
    wishes = F.transform("wishes", lambda w: F.struct(w["goal"].alias("goal"), F.greatest(w["low"], F.coalesce(F.col("kth")[w["goal"]], w["low"])).alias("low"), w["high"].alias("high")))
    return anchors.join(kth, F.col("rid") == F.col("anchor_rid"), "left").select(*[wishes.alias("wishes") if c == "wishes" else c for c in anchors.columns])


def _best(anchors: DataFrame, buckets: DataFrame, metas: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(anchor_rid, goal, rid, vec_id, score, rank) of each wish of the anchors."""
    blocks = _blocked(anchors)
    first = _search(buckets, _pairs(blocks, metas, same_label, True), blocks, k)
    blocks = _blocked(written(_seeded(anchors, first, k), "negative-seeds"))
    return written(_search(buckets, _pairs(blocks, metas, same_label, False), blocks, k), "negative-found")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, k_positives: int = K, k: int = K, least_percent: int = LEAST,
                   id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, the rows that ``is_anchor`` (a condition on ``vec_id``) holds for."""
    spark = vectors.sparkSession
    ship_code(spark)
    buckets = written(_bucketed(written(labelled_integers(vectors, label, id_col, vec_col), "negative-vectors")), "negative-buckets")
    metas = written(buckets.groupBy(*BUCKET_KEY).agg(F.max("len").alias("longest")), "negative-lengths")
    anchors = buckets.where(is_anchor).select("rid", "vec_id", "label", "v", "len")
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("goal"), F.lit(-LONG).cast("long").alias("low"), F.lit(LONG - 1).cast("long").alias("high")))
    positives = _best(anchors.withColumn("wishes", any_score), buckets, metas, True, k_positives)
    # A negative's score s is wanted if least_percent * p <= 100 * s <= 100 * p, which no s meets for p < 0.
    low = F.ceil(F.col("score").cast("decimal(38,0)") * least_percent / 100).cast("long")
    wishes = positives.where("score >= 0").groupBy("anchor_rid").agg(F.collect_list(F.struct(F.col("rid").alias("goal"), low.alias("low"), F.col("score").alias("high"))).alias("wishes"))
    asking = written(anchors.join(wishes, F.col("rid") == F.col("anchor_rid")).select("rid", "vec_id", "label", "v", "len", "wishes"), "negative-wishes")
    negatives = _best(asking, buckets, metas, False, k)
    named = positives.select("anchor_rid", F.col("rid").alias("goal"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (negatives.join(named, ["anchor_rid", "goal"]).join(anchors.select(F.col("rid").alias("anchor_rid"), F.col("vec_id").alias("anchor_id")), "anchor_rid")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def op13(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id").cast("long") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
