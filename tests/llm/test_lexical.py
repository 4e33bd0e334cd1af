import math
import random
import re

import duckdb
import numpy as np
import pytest
from edge_docs import TEXTS, edge_docs, empty_docs, prose

from peakflow.llm import lexical, queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    """Sorted answers for (doc_id, text) rows and (item_id, text) rows."""
    found = [(i if i is not None else 1 << 63, words(t)) for i, t in docs]
    found = [(i, ws) for i, ws in found if ws]
    n, total, out = len(found), sum(len(ws) for _, ws in found), []
    for item, text in set(items):
        asked = set(words(text))
        df = {t: sum(t in ws for _, ws in found) for t in asked}
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in asked}
        ranked = []
        for i, ws in found:
            m = 10 + (90 * len(ws) * n) // total
            score = sum(weight[t] * (10 ** 9 * ws.count(t) // (1000 * ws.count(t) + 8 * m)) for t in asked & set(ws))
            if score > 0:
                ranked.append((-score, i))
        out += [(item, r + 1, i if i < 1 << 63 else None, -s) for r, (s, i) in enumerate(sorted(ranked)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, monkeypatch, seed):
    for name, value in (("TREE", 40), ("DOC_LEAF", 3), ("ITEM_LEAF", 2), ("FANOUT", 3), ("SEED_DOCS", 30)):
        monkeypatch.setattr(lexical, name, value)
    rnd = random.Random(seed)
    docs = [(i, prose(rnd.randrange(0, 60), rnd) + rnd.choice(["", " Éa", " ÉA É2", " x-Y_z"])) for i in range(150)]
    items = [(i % 20, prose(rnd.randrange(0, 12), rnd) + rnd.choice(["", " éa x", " É2 nothere"])) for i in range(25)]
    assert got(lexical.ranked_search(*frames(spark, docs, items))) == brute(docs, items)
    assert got(lexical.ranked_search(*frames(spark, docs, items), k=3)) == brute(docs, items, 3)


def test_chunks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK_TERMS", 20)
    rnd = random.Random(7)
    docs, items = [(i, prose(30, rnd)) for i in range(40)], [(i, prose(8, rnd)) for i in range(9)]
    assert got(lexical.ranked_search(*frames(spark, docs, items))) == brute(docs, items)


def test_whole_batches_are_pruned():
    """With a few topics that share no words, an item meets the documents of its own topic alone."""
    rnd = np.random.default_rng(1)
    n, topics, size = 2000, 20, 30
    weights = np.full(topics * size, 1000, np.int64)
    topic = np.sort(rnd.integers(0, topics, n))
    term = np.concatenate([np.sort(rnd.choice(size, 5, replace=False)) + t * size for t in topic])
    docs = lexical.Documents(np.arange(n), np.arange(n + 1) * 5, term, rnd.integers(1, 1000, len(term)))
    items = lexical.Items(list(range(topics)), [np.arange(3) + t * size for t in range(topics)], weights)
    best = lexical.Best(topics, 10, np.zeros(topics, np.int64))
    assert lexical.descend(items, docs, best) < n * topics / 2  # leaves hold 8 of the 20 items
    for i, t in enumerate(a[0] // size for a in items.asked):
        score = [int(sum(1000 * o for x, o in zip(term[d * 5:d * 5 + 5], docs.offer[d * 5:d * 5 + 5], strict=True) if x in items.asked[i])) for d in range(n)]
        assert list(zip(best.score[i].tolist(), best.doc[i].tolist(), strict=True)) == [(-s, d) for s, d in sorted((-s, d) for d, s in enumerate(score) if s)[:10]] and t >= 0


def test_odd_rows(spark):
    docs = [*enumerate(TEXTS), (3, "tie text"), (None, "tie text"), (None, "tie")]
    items = [(1, "tie text"), (1, "tie text"), (2, None), (2, ""), (None, "no such thing"), (4, "ID HERE"), (5, TEXTS[6][:5000]), (4, "日本語")]
    assert got(lexical.ranked_search(*frames(spark, docs, items))) == brute(docs, items)
    columns = edge_docs(spark)
    assert lexical.ranked_search(columns, spark.createDataFrame([(1, "one two", 3)], "item_id long, text string, doc_id int")).count() == 2


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a")], [(1, "a")])
    assert lexical.ranked_search(empty_docs(spark), items).collect() == []
    assert lexical.ranked_search(docs, items.limit(0)).collect() == []


def test_table(spark):
    base = "/root/testdata/sf0.01"
    for t in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    want = duckdb.sql(f"SELECT item_id, rank, doc_id, score FROM ({lexical.ORACLE})").fetchall()
    assert got(queries.op11_lexical_search(spark, base)) == sorted(want, key=repr) and want
