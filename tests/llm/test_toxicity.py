import random
import zlib

import numpy as np
from edge_docs import TEXTS, edge_docs, empty_docs, prose, with_documents
from pyspark.sql import functions as F

from peakflow.llm import queries, toxicity


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_margins_are_those_of_all_pairs():
    rnd = np.random.default_rng(1)
    m = toxicity.Machine(np.array([3, 5, 9]), 0.3, np.array([0, 0.5, -0.2, 0.1]), np.vstack([np.zeros(4), rnd.normal(size=(3, 4))]))
    got = m.score(np.array([3, 9, 77, 5]), np.array([0, 3, 3, 4]))
    want = [0.3 + 0.5 + 0.1 + m.v[1] @ m.v[3], 0.3, 0.3 - 0.2]
    assert np.allclose(got, 1 / (1 + np.exp(-np.array(want))))


def test_pairs_of_terms_are_learnt():
    """Two harmless terms that are toxic only together: no sum of weights separates them."""
    rnd = np.random.default_rng(0)
    a, b = rnd.random(3000) < 0.5, rnd.random(3000) < 0.5
    texts = [[x for x, there in ((1, p), (2, q)) if there] + [3 + int(z) for z in rnd.integers(0, 5, 1)] for p, q, z in zip(a, b, a, strict=True)]
    y = (a & b).astype(float)
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    m = toxicity.fit(np.concatenate(texts), cuts, y)
    assert ((m.score(np.concatenate(texts), cuts) >= 0.5) == y).mean() > 0.99


def test_planted_words_are_found_on_held_out_rows(spark, tmp_path):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        words = prose(120, rnd).split()
        for _ in range(3 * bad):
            words[rnd.randrange(120)] = rnd.choice(["Zorgish", "zorgling", "vleckt", "vleck"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    base = with_documents(spark, tmp_path, spark.createDataFrame(rows, "doc_id long, text string"), labels)
    got = queries.op5_toxicity(spark, base).collect()
    held = [(r.score, labels[r.doc_id][2]) for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert auc(np.array([s for s, _ in held]), np.array([y for _, y in held])) > 0.98
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_held_out_accuracy_on_the_table(spark):
    base = "/root/testdata/sf0.1"
    y = {r.doc_id: r.toxic for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    got = [r for r in queries.op5_toxicity(spark, base).collect() if r.held_out and r.doc_id in y]
    s, t = np.array([r.score for r in got]), np.array([y[r.doc_id] for r in got])
    assert auc(s, t) > 0.95
    assert ((s >= 0.5) & (t == 0)).sum() <= 0.02 * (t == 0).sum()


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, tmp_path):
    rows = [(i, ("zorg " if i % 3 == 0 else "") + prose(30, random.Random(i)), "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = toxicity.held_out(F.col("doc_id"))
    held = {r.doc_id for r in docs.where(out).collect()}
    got = []
    for flip in (0, 1):
        labels = [(i, 0, int(i % 3 == 0) ^ (flip & (i in held))) for i in range(200)]
        model = toxicity.train(docs.withColumn("lang", F.lit(str(flip))), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        got.append([r.score for r in toxicity.score(docs, model).collect()])
    assert got[0] == got[1]


def test_repeated_ids_are_one_row_of_training(spark, monkeypatch):
    rows = [(i, ("zorg " if i % 3 == 0 else "") + prose(30, random.Random(i))) for i in range(100)]
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(100)], "doc_id long, quality int, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows + [rows[1]] * 50 + [rows[3]] * 20, "doc_id long, text string")
    a, b = (toxicity.Machine.load(toxicity.train(d, labels)) for d in (once, often))
    assert np.array_equal(a.known, b.known) and np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)


def test_edge_documents(spark, tmp_path):
    labels = [(0, 1, 1), (0, 1, 0), (5, 1, 0), (6, None, None), (None, 1, 1), (999, 1, 1), (6, 0, 1)]
    docs = edge_docs(spark)
    got = queries.op5_toxicity(spark, with_documents(spark, tmp_path, docs, labels)).collect()
    assert len(got) == len(TEXTS) + 2 and all(0 <= r.score <= 1 for r in got)
    same = {r.score for r in got if r.doc_id in (0, 1)}
    assert len(same) == 1
    kept = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame([(5, 0, 1)], "doc_id long, quality int, toxic int")))
    assert kept.columns == [*[c for c in docs.columns if c != "score"], "score"] and {r.terms for r in kept.collect()} == {"t"}


def test_without_labels_or_rows(spark, tmp_path):
    got = queries.op5_toxicity(spark, with_documents(spark, tmp_path, edge_docs(spark))).collect()
    assert {r.score for r in got} == {0.0}
    assert queries.op5_toxicity(spark, with_documents(spark, tmp_path / "e", empty_docs(spark), [(1, 1, 1)])).collect() == []


def test_pairs_of_terms_with_the_mean_rate_alone_are_learnt():
    """Toxic if just one of two terms is there, so each alone has the mean rate; with five other terms a text."""
    def sample(n, seed):
        rnd = np.random.default_rng(seed)
        a, b = rnd.random(n) < 0.5, rnd.random(n) < 0.5
        texts = [[x for x, there in ((1, p), (2, q)) if there] + list(3 + rnd.choice(400, 5, replace=False)) for p, q in zip(a, b, strict=True)]
        return np.concatenate(texts).astype(int), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), (a ^ b).astype(float)

    m = toxicity.fit(*sample(4000, 1))
    hashed, cuts, y = sample(2000, 2)
    assert ((m.score(hashed, cuts) >= 0.5) == y).mean() > 0.9
