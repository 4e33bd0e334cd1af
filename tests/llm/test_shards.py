import math
from collections import Counter, defaultdict

import pytest
from edge_docs import TEXTS, edge_docs, empty_docs
from pyspark.sql import functions as F

from peakflow.llm import queries, shards
from peakflow.llm.base import texts


def check(rows, limit):
    size, docs = defaultdict(int), Counter(r.shard for r in rows)
    inner, inner_docs = defaultdict(int), Counter()
    for r in rows:
        size[r.shard] += r.n_bytes
        for k in range(len(r.shard)):
            inner[r.shard[:k]] += r.n_bytes
            inner_docs[r.shard[:k]] += 1
    names = sorted(docs)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))  # every row has one shard
    assert all(n <= limit or docs[s] == 1 for s, n in size.items())
    assert all(n > limit and inner_docs[s] > 1 for s, n in inner.items())  # only oversized buckets are split
    assert all((r.shard_bytes, r.shard_docs, r.depth) == (size[r.shard], docs[r.shard], len(r.shard)) for r in rows)
    assert all(r.oversize == (r.n_bytes > limit) for r in rows)


def directory(rows, limit):
    """{row: shard} by a directory that takes row after row; rows are (row, bytes, bits)."""
    slots, bits = [["", []]], 0  # slot i of 2 ** bits points to the bucket [prefix, rows]
    for row in rows:
        bucket = slots[int("0" + row[2][:bits], 2)]
        bucket[1].append(row)
        full = [bucket]
        while full:
            prefix, held = b = full.pop()
            if sum(n for _, n, _ in held) <= limit or len(held) == 1:
                continue
            if len(prefix) == bits:
                slots, bits = [x for x in slots for _ in "01"], bits + 1
            halves = [[prefix + c, [r for r in held if r[2][len(prefix)] == c]] for c in "01"]
            for i in [i for i, x in enumerate(slots) if x is b]:
                slots[i] = halves[int(f"{i:0{bits}b}"[len(prefix)])]
            full += halves
    return {r: b[0] for b in {id(x): x for x in slots}.values() for r, _, _ in b[1]}


@pytest.mark.parametrize("limit", [50_000, 8_000, 2_500])
def test_shards_are_those_of_a_directory_filled_step_by_step(spark, limit):
    docs = queries.documents(spark, "/root/testdata/sf0.001").limit(300).select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(7, "the same row again " * 40)] * 30, docs.schema)).coalesce(1)
    rows = texts(docs).select("rid", F.octet_length("text").alias("n"), F.xxhash64("doc_id", "text").alias("h"), F.xxhash64("rid").alias("more")).collect()
    total = sum(r.n for r in rows)
    first = min(shards.MOST, max(1, math.ceil(math.log2(total / limit)) if total > limit else 0) + shards.SLACK)
    word = lambda x: f"{x % 2 ** 64:064b}"
    want = directory([(r.rid, r.n, word(r.h)[:first] + word(r.more)) for r in rows], limit)
    assert {r.rid: r.shard for r in shards.assign(docs, limit).collect()} == want


@pytest.mark.parametrize("limit", [10, 1000, 1 << 30])
def test_edge_documents(spark, limit):
    rows = shards.assign(edge_docs(spark), limit).collect()
    assert len(rows) == len(TEXTS) + 2
    check(rows, limit)


@pytest.mark.parametrize("limit", [shards.LIMIT, 20_000, 3_000])
def test_table(spark, limit):
    docs = queries.documents(spark, "/root/testdata/sf0.001")
    rows = shards.assign(docs, limit).collect()
    assert len(rows) == docs.count()
    check(rows, limit)


def test_a_third_of_equal_rows(spark):
    rows = [(None, "same text " * 10)] * 200 + [(i, f"other text {i} " * 8) for i in range(400)]
    got = shards.assign(spark.createDataFrame(rows, "doc_id long, text string"), 900).collect()
    assert len(got) == 600
    check(got, 900)


def test_written_shards(spark, tmp_path):
    docs = queries.documents(spark, "/root/testdata/sf0.001")
    where = shards.write_shards(docs, f"{tmp_path}/out", 50_000)
    back = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out")
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((r.doc_id, r.text) for r in docs.collect())
    assert {r.shard for r in back.collect()} == {"b" + r.shard for r in where.collect()}


def test_empty_table(spark):
    assert shards.assign(empty_docs(spark)).collect() == []
