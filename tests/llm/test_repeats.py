import random

import numpy as np
import pytest
from edge_docs import TEXTS, edge_docs, empty_docs, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from peakflow.llm import queries, repeats, suffixes


def brute(texts, window=100):
    """{id: (kept bytes, removed spans)}, window by window, for texts of distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(texts.items()):
        body = (t or "").encode()
        gone = bytearray(len(body))
        for at in range(len(body) - window + 1):
            w = hash(body[at:at + window]) if window > 50 else body[at:at + window]
            if w in seen:
                gone[at:at + window] = b"\1" * window
            seen.add(w)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]]).astype(int)))
        out[i] = (bytes(b for b, g in zip(body, gone, strict=True) if not g), [tuple(e) for e in edges.reshape(-1, 2).tolist()])
    return out


def got(docs, **kw):
    return {r.doc_id: (bytes(r.kept), [tuple(s) for s in r.spans]) for r in repeats.remove_repeats(docs, **kw).collect()}


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=70), st.integers(1, 30))
def test_ranks_order_suffixes_to_their_depth(symbols, depth):
    order = np.argsort(suffixes.suffix_ranks(np.array(symbols, np.int64), depth), kind="stable")
    heads = [symbols[i:i + depth] for i in order]
    assert heads == sorted(heads)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 8), st.integers(0, 20))
def test_cells_cover_every_window_start_once(text, gram, more):
    window = gram + more
    found = [(s + i, g) for gs, _, starts, ns in suffixes.cells(text, window, gram) for g, s, n in zip(gs, starts, ns, strict=True) for i in range(n)]
    assert [s for s, _ in found] == list(range(max(0, len(text) - window + 1)))
    by_window = {}
    for s, g in found:  # equal windows share a gram
        assert by_window.setdefault(text[s:s + window], g) == g


def test_pieces_of_long_texts_share_windows(monkeypatch):
    rnd = random.Random(1)
    text = prose(600, rnd).encode()
    whole = {s + i: g for gs, _, ss, ns in suffixes.cells(text, 100, 32) for g, s, n in zip(gs, ss, ns, strict=True) for i in range(n)}
    monkeypatch.setattr(suffixes, "PIECE", 256)
    assert whole == {s + i: g for gs, _, ss, ns in suffixes.cells(text, 100, 32) for g, s, n in zip(gs, ss, ns, strict=True) for i in range(n)}


def documents_with_repeats(rnd):
    base = [prose(rnd.randrange(0, 120), rnd) for _ in range(12)]
    texts = {}
    for i in range(60):
        a, b = rnd.choice(base), rnd.choice(base)
        cut = rnd.randrange(len(a) + 1)
        texts[i * 3] = rnd.choice([a, a[:cut] + b[cut:], a + " " + b + " " + a, prose(60, rnd), "é" * rnd.randrange(200), "ab" * rnd.randrange(150),
                                   a[:cut] + rnd.choice("xyz") + a[cut + 1:]])
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_against_every_window(spark, seed):
    texts = documents_with_repeats(random.Random(seed))
    assert got(frame(spark, texts)) == brute(texts)
    assert got(frame(spark, texts), window=20, gram=8) == brute(texts, 20)


def test_hot_and_crowded_grams(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLE_DOCS", 20)
    monkeypatch.setattr(repeats, "HOT_SHARE", 0.1)
    monkeypatch.setattr(repeats, "CELLS", 3)
    rnd = random.Random(5)
    passage = prose(30, rnd)
    texts = {i: f"{prose(rnd.randrange(20), rnd)} {passage if i % 3 else passage[:150] + str(i)} {prose(5, rnd)}" for i in range(80)}
    assert got(frame(spark, texts)) == brute(texts)


def test_small_batches(spark, monkeypatch):
    """Grams go on from batch to batch."""
    monkeypatch.setattr("peakflow.llm.base.BATCH_ROWS", 7)
    texts = documents_with_repeats(random.Random(9))
    assert got(frame(spark, texts)) == brute(texts)
    monkeypatch.undo()


def test_edge_documents(spark):
    docs = edge_docs(spark).withColumn("kept", repeats.F.lit("k")).withColumn("id", repeats.F.lit(4)).withColumn("body", repeats.F.lit("b"))
    out = repeats.remove_repeats(docs)
    assert set(out.columns) == {*docs.columns, "spans"}
    want = brute(dict(enumerate(TEXTS)))
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        if r.doc_id is not None:
            assert (bytes(r.kept), [tuple(s) for s in r.spans]) == want[r.doc_id]


def test_null_ids_come_last_and_equal_rows_are_one(spark):
    rnd = random.Random(2)
    a, b = prose(40, rnd), prose(40, rnd)
    rows = [(None, a), (7, a), (7, a), (3, b), (None, b + a), (9, "")]
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    n_left = sorted((r.doc_id or 99, len(r.kept)) for r in out)
    assert n_left[:4] == [(3, len(b)), (7, len(a)), (7, len(a)), (9, 0)] and n_left[4:] == [(99, 0), (99, 0)]


def test_empty_table(spark):
    assert repeats.remove_repeats(empty_docs(spark)).collect() == []


def test_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    want = brute(texts)
    rows = queries.op12_repeated_bytes(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    import hashlib
    for r in rows:
        kept, spans = want[r.doc_id]
        n = len((texts[r.doc_id] or "").encode())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
