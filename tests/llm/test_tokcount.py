import random

import pyarrow as pa
import pytest
import sentencepiece
from edge_docs import TEXTS, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path

from peakflow.llm import queries, tokcount
from peakflow.llm.transducer import Transducer, scan

FILE = path("piece_bpe_32k.model")
ALPHABETS = ["abcdefgh   ", "ab ▁\n", "日本語テスト é ß½①😀\x00\n ", "0123456789abcdef", "<s></s> \t\n▁", "    a"]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


@pytest.fixture(scope="module")
def machine():
    return Transducer(FILE)


def test_counts_are_the_models(sp, machine):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(a) for _ in range(rnd.choice([1, 2, 5, 20, 60, 200]))) for a in ALPHABETS for _ in range(200)]
    assert machine.count(pa.array([" " + t for t in texts])).tolist() == [len(x) for x in sp.encode(texts)]


@settings(max_examples=150, deadline=None)
@given(st.text(min_size=1, max_size=60), st.integers(1, 12))
def test_chunk_maps_compose(sp, machine, text, size):
    s = " " + text
    maps = []
    for i in range(0, len(s), size):
        head, middle, tail = machine.chunk_map(s[i:i + size])
        assert head + (middle or "") + tail == s[i:i + size]
        maps.append((head, None if middle is None else int(machine.count(pa.array([middle]))[0]), tail))
    head, middle, tail = scan(maps, machine.line)
    assert machine.line(head) + (middle or 0) + machine.line(tail) == len(sp.encode(text))


def test_tables_may_be_emptied_at_any_time(sp, monkeypatch):
    monkeypatch.setattr("peakflow.llm.transducer.CACHE", 20)
    m = Transducer(FILE)
    texts = [t for t in TEXTS if t and len(t) < 1000]
    assert m.count(pa.array([" " + t for t in texts])).tolist() == [len(x) for x in sp.encode(texts)]


@pytest.mark.parametrize("chunk", [tokcount.CHUNK, 17])
def test_edge_documents(spark, sp, chunk):
    texts = [t if t is None else t[:3000] for t in TEXTS]
    rows = tokcount.token_counts(edge_docs(spark, texts), FILE, limit=50, chunk=chunk).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "no id here" if r.doc_id is None else texts[r.doc_id] or ""
        n = len(sp.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 50)


def test_empty_table(spark):
    assert tokcount.token_counts(empty_docs(spark), FILE).collect() == []


def test_query_on_the_table(spark, sp):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op4_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(sp.encode(t)) for i, t in docs.items()}
