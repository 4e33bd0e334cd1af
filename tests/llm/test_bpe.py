import hashlib

import numpy as np
import pytest
from edge_docs import TEXTS, edge_docs, empty_docs
from public_tokenizers import path
from tokenizers import Tokenizer

from peakflow.llm import bpe, queries

FILE = path("byte_bpe_50k.json")
HARD = ["  a  b ", "it's we'll 'S", "½①Ⅳ", "\x1c\x1d a\x85b", "a\n\n\n b\t\tc\r\n", "x  <|endoftext|> y", "<|endoftext|>" * 3,
        "᠎​﻿", "é", "👍🏽 ok", "a  b", "123 4.5"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(FILE)
    return lambda s: t.encode(s or "", add_special_tokens=False).ids, lambda ids: t.decode(ids, skip_special_tokens=False)


def test_ids_and_text_are_the_tokenizers(spark, reference):
    encode, decode = reference
    docs = edge_docs(spark, TEXTS + HARD)
    rows = bpe.decode(bpe.encode(docs, FILE), FILE).collect()
    assert len(rows) == docs.count()
    assert set(rows[0].asDict()) == {*docs.columns, "decoded"}  # "ids" is replaced, all else is kept
    for r in rows:
        ids = encode(r.text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == decode(ids)
        assert r.words == "w"


def test_rare_words_outside_the_table(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_WORDS", 3)
    monkeypatch.setattr(bpe, "WORD_BYTES", 4)
    for r in bpe.encode(edge_docs(spark), FILE).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == reference[0](r.text)


def test_word_table_counts_each_distinct_word(spark, reference):
    docs = spark.createDataFrame([(1, "to be or not to be"), (2, "to be")], "doc_id long, text string")
    got = {r.word: (r.n, np.frombuffer(r.ids, "<u4").tolist()) for r in bpe.word_table(docs, FILE).collect()}
    assert {w: n for w, (n, _) in got.items()} == {"to": 2, " be": 3, " or": 1, " not": 1, " to": 1}
    assert all(ids == reference[0](w) for w, (_, ids) in got.items())


def test_decoding_ids_that_are_no_text(spark, reference):
    ids = [[], [50256], [255, 128, 200], [99_999], [15496, 995]]
    df = spark.createDataFrame([(np.array(x, "<u4").tobytes(),) for x in ids] + [(None,)], "ids binary")
    got = [r.decoded for r in bpe.decode(df, FILE).collect()]
    assert got == [reference[1]([i for i in x if i < 50257]) for x in ids] + [""]


def test_query_on_edge_and_empty_documents(spark, reference):
    rows = bpe.op10(spark, edge_docs(spark), FILE).collect()
    for r in rows:
        if r.doc_id is not None:
            ids = reference[0](TEXTS[r.doc_id])
            assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert bpe.op10(spark, empty_docs(spark), FILE).collect() == []


def test_query_on_the_table(spark, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op10_bpe_roundtrip(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference[0](docs[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(reference[1](ids).encode()).hexdigest()
