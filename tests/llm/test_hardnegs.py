import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peakflow.llm import hardnegs, queries

SCHEMA = "vec_id long, embedding array<double>, label int, rid int, v string, len string, anchors int"


def brute(rows, every=100, k=5, least=80):
    """Sorted answers for (vec_id, embedding, label) rows, anchor by anchor."""
    good = []
    for i, x, y in rows:
        if i is not None and x is not None and y is not None and all(c is not None and math.isfinite(c) for c in x):
            v = [max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * c))) for c in x]
            good.append((i, v, (y + 1) % 10 if i % 7 == 0 else y))
    out = []
    for a, (i, v, y) in enumerate(good):
        if i % every:
            continue
        scored = [(-max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(v, w, strict=True)))), j, z == y)
                  for b, (j, w, z) in enumerate(good) if a != b and len(v) == len(w)]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2]][:k]:
            rest = [s for s in scored if not s[2] and -least * p <= -100 * s[0] <= -100 * p][:k]
            out += [(i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(rest)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", "l", 2) for r in rows], SCHEMA)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def vectors(rnd, n, dim, spread=1.0):
    centre = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    out = []
    for i in range(n):
        c, size = rnd.choice(centre), math.exp(rnd.gauss(0, spread))
        out.append((i, [size * (x + rnd.gauss(0, 0.4)) for x in c], rnd.choice([0, 0, 0, 1, 2, 9])))
    return out


@pytest.mark.parametrize(("n", "dim", "spread"), [(600, 8, 1.0), (500, 3, 0.0), (400, 1, 0.5)])
def test_against_brute_force(spark, monkeypatch, n, dim, spread):
    monkeypatch.setattr(hardnegs, "BUCKET", 40)
    monkeypatch.setattr(hardnegs, "BLOCK", 3)
    rows = vectors(random.Random(n), n, dim, spread)
    assert got(hardnegs.op13(spark, frame(spark, rows))) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-5, 5)] * 3), min_size=1, max_size=30), st.tuples(*[st.integers(-5, 5)] * 3), st.integers(-80, 80))
def test_no_candidate_is_missed(rows, q, least):
    v, q = np.array(rows, dtype=np.int64), np.array(q, dtype=np.int64)
    bucket = hardnegs.Lists(np.arange(len(v)), np.arange(len(v)), v)
    assert set(np.flatnonzero(v @ q >= least)) <= set(bucket.candidates(q, least))


def test_pruning_leaves_few_candidates():
    rnd = np.random.default_rng(4)
    x = rnd.normal(0, 1, (4000, 6))
    v = (1000 * x / np.sqrt(np.square(x).sum(axis=1))[:, None]).astype(np.int64)  # one length, as in a bucket
    bucket, q = hardnegs.Lists(np.arange(4000), np.arange(4000), v), v[0]
    assert 0 < np.count_nonzero(v @ q >= 0.95 * (q @ q)) <= len(bucket.candidates(q, int(0.95 * (q @ q)))) < 400


def test_odd_rows(spark):
    rnd = random.Random(3)
    rows = vectors(rnd, 120, 4)
    rows += [(100, rows[5][1], 0), (100, rows[5][1], 0), (200, None, 1), (None, [1.0] * 4, 1), (300, [1.0, None, 1.0, 1.0], 1), (301, [1.0, math.nan, 1.0, 1.0], 1),
             (400, [1.0, math.inf, 0.0, 0.0], 1), (500, [0.0] * 4, 0), (501, [0.0] * 4, 0), (502, [0.0] * 4, 1), (600, [], 0), (601, [], 0), (602, [], 3), (700, [1.0, 2.0], 4),
             (701, [1.0, 2.0], 4), (800, [1.0] * 4, None), (900, [1e300, 0.0, 0.0, 0.0], 0), (901, [1e300, 0.0, 0.0, 0.0], 0), (902, [1e300, 1.0, 0.0, 0.0], 1)]
    assert got(hardnegs.op13(spark, frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert hardnegs.op13(spark, frame(spark, [])).collect() == []


def test_own_limits(spark):
    rows = vectors(random.Random(8), 300, 5)
    out = hardnegs.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")), 3, 3, 50)
    assert got(out) == brute(rows, 50, 3, 50)


def test_table(spark):
    base = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{base}/embeddings.parquet'")
    want = sorted(duckdb.sql(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({hardnegs.ORACLE})").fetchall())
    assert got(queries.op13_hard_negatives(spark, base)) == want and want
