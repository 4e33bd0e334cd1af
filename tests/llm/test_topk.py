import numpy as np
from edge_docs import RND
from pyspark.sql import functions as F

from peakflow.llm import topk

KIND = "vec_id long, embedding array<float>, label int, rid long, v string, score string, dim int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, 1, "v", "s", 2) for i, e in rows], KIND)


def brute(rows, is_query, k=5):
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for i, e in rows
            if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for n, (i, q) in enumerate(good):
        if is_query(i):
            scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for m, (j, c) in enumerate(good) if m != n and len(c) == len(q))
            out += [(i, r + 1, j, min(-s, 2 ** 63 - 1)) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_odd_vectors_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 7)
    rows = [(i, [RND.uniform(-1, 1) for _ in range(19)]) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (101, rows[0][1]), (100, [0.0] * 19)]  # ties, and repeated rows
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 19), (203, [float("inf")] * 19), (None, rows[1][1]), (50, [0.5, -0.25]), (150, [1.0, 2.0]), (250, [])]
    got = result(topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0))
    assert got == brute(rows, lambda i: i % 50 == 0)


def test_components_that_a_double_cannot_sum(spark):
    rows = [(0, [1e7, 1.0]), (1, [1e7, 1.5]), (2, [1e7, -1.5]), (3, [9e6, 0.0])]
    assert result(topk.top_k(frame(spark, rows), F.col("vec_id") == 0)) == brute(rows, lambda i: i == 0)
    (r,) = topk.top_k(frame(spark, [(0, [1e30]), (1, [1e30])]), F.col("vec_id") == 0).collect()
    assert r.score == 2 ** 63 - 1


def test_pruning_keeps_the_best():
    rnd = np.random.default_rng(3)
    q, c = rnd.integers(-300, 300, (64, 9)), rnd.integers(-300, 300, (64, 800))
    ids = rnd.permutation(800)
    got = topk.block_top(q, np.arange(-9, 0), c, np.arange(800), ids, 5)
    assert got == topk._plain_top(q, np.arange(-9, 0), c, np.arange(800), ids, 5)


def test_empty_table(spark):
    assert topk.op1(spark, frame(spark, [])).collect() == []
