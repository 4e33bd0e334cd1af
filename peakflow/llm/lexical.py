"""Operator 11: ranked lexical search as an exact dual-tree search.

An item asks for terms, each with a weight; a document offers each term a saturated frequency; the score is the
sum of the products. Both are vectors without negative coordinates, so the product of two coordinate-wise maxima
bounds every pair below them. Items are ordered by their heaviest terms and gathered in a hierarchy whose nodes hold the
maxima of their items' weights. Documents keep only the terms that items ask for (taken from whole texts in one
narrow pass), are dealt by their strongest terms so that alike ones meet, and every ``TREE`` documents of a task make
a hierarchy whose nodes hold the maxima of their offers. The search goes down both at once, best documents first: a
pair of nodes whose bound is below the weakest k-th score of the items under it is dropped with all of its
pairs; scores of the remaining leaves are exact. K-th scores start from a search over a hash sample of documents.

Items go in chunks of about ``CHUNK_TERMS`` terms, so that a chunk's vocabulary and hierarchy (broadcast) have a bounded size;
each chunk is a pass over the documents, whose number grows with the items alone.

Defined results: a null text has no terms, and a document without terms isn't counted; documents without an id come last among
equal scores (an id of the largest long counts as none); repeated rows are documents of their own; items equal in id and text are one, other items of
one id each have their own ranks; items without a scoring document give no rows; scores of 0 aren't ranked; empty tables give empty
ones; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import hash_sample, ship_code, tidy, written

K = 10
#: Terms (with repeats) of the items of one pass, documents of a hierarchy and of its leaves, items of a leaf, children of a node.
CHUNK_TERMS, TREE, DOC_LEAF, ITEM_LEAF, FANOUT = 1_000_000, 2048, 32, 8, 8
#: Documents whose scores start the search.
SEED_DOCS = 4000
#: Percent of a document's length that counts in its offers, and the numbers of the offer.
LENGTH_PERCENT, SCALE, ONE, SLOPE = 90, 1_000_000_000, 1000, 8
LAST = (1 << 63) - 1

#: Term bytes, in lower case; all others part terms. Bytes of characters from 80 hex on are term bytes.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def _items(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(item_id, chunk hash, body) of the distinct items."""
    known = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct()
    return known.select("item_id", F.xxhash64("text", "item_id").alias("h"), F.col("text").cast("binary").alias("body"))


def _offers(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, n, term array<int>, tf array<int>): every document's length in terms, and the asked terms in it."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc_id"),
                       F.xxhash64(F.lit(11), text_col, id_col).alias("h"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))

    def run(batches):
        number = vocabulary.value
        for b in batches:
            n, at, term, tf = [], [0], [], []
            for body in b.column(2):
                words = terms(body.as_buffer().to_pybytes())
                asked, times = np.unique(np.fromiter((number[w] for w in words if w in number), np.int32), return_counts=True)
                n.append(len(words))
                at.append(at[-1] + len(asked))
                term.append(asked)
                tf.append(times.astype(np.int32))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(x or [np.zeros(0, np.int32)]).astype(np.int32))) for x in (term, tf)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(n, pa.int64()), *lists], names=["doc_id", "h", "n", "term", "tf"])

    return rows.mapInArrow(tidy(run), "doc_id long, h long, n long, term array<int>, tf array<int>")


class Items:
    """The items of a chunk in a hierarchy: ``nodes`` are (first, end, children) over items in order, the root last."""

    def __init__(self, ids: list, asked: list[np.ndarray], weights: np.ndarray):
        self.leaf, self.fanout = ITEM_LEAF, FANOUT
        heavy = [a[np.argsort(-weights[a], kind="stable")[:2]].tolist() for a in asked]
        order = sorted(range(len(ids)), key=lambda i: (heavy[i], i))
        self.ids, self.asked, self.weights = [ids[i] for i in order], [asked[i] for i in order], weights
        self.levels = [[(i, min(i + ITEM_LEAF, len(ids))) for i in range(0, len(ids), ITEM_LEAF)]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append([(below[i][0], below[min(i + FANOUT, len(below)) - 1][1]) for i in range(0, len(below), FANOUT)])
        # Whoever asks for a term, as places in order.
        flat = np.concatenate([*self.asked, np.zeros(0, np.int64)]).astype(np.int64)
        who = np.repeat(np.arange(len(ids)), [len(a) for a in self.asked])
        by_term = np.argsort(flat, kind="stable")
        self.who, self.cuts = who[by_term], np.searchsorted(flat[by_term], np.arange(len(weights) + 1))

    def maxima(self, term: np.ndarray, level: int) -> np.ndarray:
        """Rows: the nodes of a level; columns: the weight of each given term under them (0 if no item asks for it)."""
        step = self.leaf * self.fanout ** level if level >= 0 else 1
        count = len(self.levels[level]) if level >= 0 else len(self.ids)
        out = np.zeros((count, len(term)), np.int64)
        sizes = self.cuts[term + 1] - self.cuts[term]
        column = np.repeat(np.arange(len(term)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.cuts[term], sizes)
        out[self.who[at] // step, column] = self.weights[term][column]
        return out


class Best:
    """The first k (score, smaller id first) of each item so far; ``kth`` starts at known lower bounds."""

    def __init__(self, n: int, k: int, kth: np.ndarray):
        self.k, self.kth = k, kth.copy()
        self.score, self.doc = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n

    def add(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        good = (score > 0) & (score >= self.kth[item])
        if good.any():
            s, d = np.concatenate([self.score[item], score[good]]), np.concatenate([self.doc[item], doc[good]])
            first = np.lexsort((d, -s))[:self.k]
            self.score[item], self.doc[item] = s[first], d[first]
            if len(first) == self.k:
                self.kth[item] = max(self.kth[item], int(s[first[-1]]))


class Documents:
    """Offers of some documents (``cuts`` into term and offer), in leaves and nodes of maxima; levels from the leaves up."""

    def __init__(self, doc_id: np.ndarray, cuts: np.ndarray, term: np.ndarray, offer: np.ndarray):
        self.doc_id, self.cuts, self.term, self.offer = doc_id, cuts, term, offer
        ends = [(i, min(i + DOC_LEAF, len(doc_id))) for i in range(0, len(doc_id), DOC_LEAF)]
        self.levels = [[self._node(cuts[a], cuts[b], term, offer) + ((a, b),) for a, b in ends]]
        while len(self.levels[-1]) > 1:
            below, up = self.levels[-1], []
            for i in range(0, len(below), FANOUT):
                under = below[i:i + FANOUT]
                t, o = np.concatenate([x[0] for x in under]), np.concatenate([x[1] for x in under])
                up.append(self._node(0, len(t), t, o) + ((i, i + len(under)),))
            self.levels.append(up)

    @staticmethod
    def _node(a: int, b: int, term: np.ndarray, offer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((-offer[a:b], term[a:b]))
        t, o = term[a:b][order], offer[a:b][order]
        first = np.concatenate([[True], t[1:] != t[:-1]])[:len(t)]
        return t[first], o[first]


def descend(items: Items, docs: Documents, best: Best) -> int:
    """Bring ``best`` up to date with the documents; the number of pairs of an item and a document that were scored."""
    scored = 0

    def bounds(term, offer, level, nodes):
        return items.maxima(term, level)[nodes] @ offer

    def weakest(level, nodes):
        return np.array([best.kth[slice(*items.levels[level][i])].min() for i in nodes])

    def visit(doc_level, doc_node, item_level, nodes):
        nonlocal scored
        term, offer, (a, b) = docs.levels[doc_level][doc_node]
        # Item nodes under which a score may still count; those of the level below follow from them.
        while True:
            bound = bounds(term, offer, item_level, nodes)
            nodes = nodes[(bound > 0) & (bound >= weakest(item_level, nodes))]
            if item_level == 0 or not len(nodes):
                break
            item_level -= 1
            nodes = np.concatenate([np.arange(i * items.fanout, min((i + 1) * items.fanout, len(items.levels[item_level]))) for i in nodes])
        if not len(nodes):
            return
        if doc_level:
            below = docs.levels[doc_level - 1]
            reach = [bounds(*below[c][:2], item_level, nodes).max() for c in range(a, b)]
            for c in np.argsort(-np.array(reach), kind="stable"):
                visit(doc_level - 1, a + int(c), item_level, nodes)
            return
        lo, hi = docs.cuts[a], docs.cuts[b]
        t, o = docs.term[lo:hi], docs.offer[lo:hi]
        places, inverse = np.unique(t, return_inverse=True)
        weight = items.maxima(places, -1)
        heads = docs.cuts[a:b] - lo
        some = np.diff(docs.cuts[a:b + 1]) > 0
        for node in nodes:
            x, y = items.levels[0][node]
            score = np.zeros((y - x, b - a), np.int64)
            if some.any():
                score[:, some] = np.add.reduceat(weight[x:y][:, inverse] * o, heads[some], axis=1)
            scored += score.size
            for i in range(x, y):
                best.add(i, score[i - x], docs.doc_id[a:b])

    if len(docs.doc_id) and items.ids:
        visit(len(docs.levels) - 1, 0, len(items.levels) - 1, np.arange(len(items.levels[-1])))
    return scored


def _tops(offers: DataFrame, items, kth, counted: int, length: int, k: int) -> DataFrame:
    """(item, doc_id, score): every task's first k documents of each item."""
    def run(batches):
        tree, best, held, size = items.value, None, [], 0

        def search():
            b = pa.concat_batches(held)
            n, term, tf = np.asarray(b.column(1)), b.column(2), b.column(3)
            cuts = np.asarray(term.offsets).astype(np.int64)
            m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * counted) // max(1, length)
            times = np.asarray(tf.flatten()).astype(np.int64)
            offer = (SCALE * times) // (ONE * times + SLOPE * np.repeat(m, np.diff(cuts)))
            descend(tree, Documents(np.asarray(b.column(0)), cuts - cuts[0], np.asarray(term.flatten()).astype(np.int64), offer), best)

        for b in batches:
            best = best or Best(len(tree.ids), k, kth.value)
            while b.num_rows:
                part = b.slice(0, TREE - size)
                held.append(part)
                size += part.num_rows
                b = b.slice(part.num_rows)
                if size == TREE:
                    search()
                    held, size = [], 0
        if held:
            search()
        if best:
            item = np.repeat(np.arange(len(tree.ids)), [len(s) for s in best.score])
            score, doc = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (best.score, best.doc))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc), pa.array(score)], names=["item", "doc_id", "score"])

    return offers.select("doc_id", "n", "term", "tf").mapInArrow(tidy(run), "item long, doc_id long, score long")


def _with_lead(offers: DataFrame, weights) -> DataFrame:
    """``offers`` with the two heaviest terms of each document."""
    def run(batches):
        for b in batches:
            cuts, term = np.asarray(b.column(3).offsets).astype(np.int64), np.asarray(b.column(3).flatten())
            cuts = cuts - cuts[0]
            doc = np.repeat(np.arange(b.num_rows), np.diff(cuts))
            term = np.append(term[np.lexsort((term, -weights.value[term], doc))], -1)
            lead = [np.where(np.diff(cuts) > i, term[np.minimum(cuts[:-1] + i, len(term) - 1)], -1).astype(np.int32) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, lead)], names=["doc_id", "h", "n", "term", "tf", "lead", "next"])

    return offers.mapInArrow(tidy(run), "doc_id long, h long, n long, term array<int>, tf array<int>, lead int, next int")


def _chunk(docs: DataFrame, items: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """The ranks of one chunk's items, given as (item_id, body)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    asked = [sorted(set(terms(bytes(body)))) for _, body in items]
    vocabulary = sorted({t for a in asked for t in a})
    number = {t: i for i, t in enumerate(vocabulary)}
    offers = written(_offers(docs, sc.broadcast(number), id_col, text_col).where("n > 0"), "lexical-offers")
    counted, length = offers.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in offers.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # a row a term of the chunk at most
        df[t] = n
    weights = np.array([math.floor(1000 * math.log((2 * counted + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    tree = Items([i for i, _ in items], [np.array([number[t] for t in a], np.int64) for a in asked], weights)
    sent = sc.broadcast(tree)
    some = offers.where(F.size("term") > 0)
    kth = np.zeros(len(tree.ids), np.int64)
    first = _tops(hash_sample(some, F.col("h"), SEED_DOCS), sent, sc.broadcast(kth), counted, length, k)
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    for item, score in first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("item", "score").collect():  # a row an item at most
        kth[item] = score
    # Documents of one strongest term lie side by side; a common one may fill many tasks.
    near = _with_lead(some, sc.broadcast(weights)).repartitionByRange("lead", "next", "h").sortWithinPartitions("lead", "next", "n")
    tops = _tops(near, sent, sc.broadcast(kth), counted, length, k)
    names = spark.createDataFrame(list(enumerate(tree.ids)), "item long, item_id long")
    ranked = tops.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", F.when(F.col("doc_id") < LAST, F.col("doc_id")).alias("doc_id"), "score")


def ranked_search(docs: DataFrame, benchmark: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): every item's first k documents."""
    spark = docs.sparkSession
    ship_code(spark)
    items = written(_items(benchmark, item_id, item_text), "lexical-items")
    total = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    chunks = max(1, math.ceil(total / (8 * CHUNK_TERMS)))
    out = None
    for c in range(chunks):
        rows = items.where(F.pmod(F.col("h"), F.lit(chunks)) == c).select("item_id", "body").collect()  # about 8 * CHUNK_TERMS bytes
        part = _chunk(docs, [(r[0], r[1]) for r in rows], k, id_col, text_col)
        out = part if out is None else out.unionByName(part)
    return out


def op11(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return ranked_search(docs, benchmark)


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), d AS (SELECT r, doc_id, ts, len(ts) AS n FROM t WHERE len(ts) > 0
), c AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM d
), i AS (
  SELECT DISTINCT item_id, text, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), p AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, nn
), s AS (
  SELECT item_id, text, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM p JOIN w USING (term) JOIN i USING (term), c GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
