import math
import random
import re
from collections import defaultdict

import pytest
from edge_docs import LONG, TEXTS, edge_docs, empty_docs, prose

from peakflow.llm import neardup, queries
from peakflow.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(texts, k=4, percent=80):
    """{id: component} by an exact prefix-filter join."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    count = defaultdict(int)
    for s in sets.values():
        for x in s:
            count[x] += 1
    seen = defaultdict(list)
    for i, s in sorted(sets.items(), key=lambda x: len(x[1])):
        order = sorted(s, key=lambda x: (count[x], x))
        near = set()
        for x in order[:len(order) - math.ceil(len(order) * percent / 100) + 1]:
            near.update(seen[x])
            seen[x].append(i)
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def hold(rows, texts, k=4):
    comp, size = brute(texts, k)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (size[r.doc_id], comp[r.doc_id], comp[r.doc_id] == r.doc_id)


def edited(words, n, rnd):
    words = list(words)
    for i in rnd.sample(range(len(words)), n):
        words[i] = f"x{rnd.random()}"
    return " ".join(words)


def test_edge_documents(spark):
    texts = [*TEXTS, "One TWO three four five", "one two three\tfour  five ", "one two three", "three two one", "É a b c d", "é a b c d", LONG + " end"]
    rows = neardup.classes(edge_docs(spark, texts)).collect()
    assert len(rows) == len(texts) + 2
    hold(rows, dict(enumerate(texts)))
    assert [(r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is None] == [(1, None, True)]


def test_empty_table(spark):
    assert neardup.classes(empty_docs(spark)).collect() == []


@pytest.mark.parametrize(("k", "block"), [(4, 8), (5, 8), (4, 1)])
def test_near_the_limit_chains_and_crowds(spark, k, block, monkeypatch):
    """Copies just above and below the limit, chains whose ends aren't alike, and a crowd around a middle that isn't its smallest."""
    monkeypatch.setattr(neardup, "BLOCK", block)  # with 1, crowds are split by their rarest shingles
    rnd = random.Random(k)
    texts = []
    for _ in range(6):
        words = [f"w{rnd.randrange(10_000)}" for _ in range(120)]
        texts += [edited(words, n, rnd) for n in (0, 1, 2, 3, 4, 5)]
    words = [f"c{i}" for i in range(150)]
    chain = words
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = edited(chain, 3, rnd).split()
    crowd = [f"m{i}" for i in range(200)]
    texts += [edited(crowd, 4, rnd) for _ in range(40)] + [" ".join(crowd)]
    common = prose(60, rnd)
    texts += [common + " " + " ".join(f"u{rnd.random()}" for _ in range(20)) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = neardup.classes(docs, k).collect()
    hold(rows, dict(enumerate(texts)), k)


def test_a_crowd_grows_linearly(spark, monkeypatch):
    """Texts around one passage, of which few are alike: every alike pair meets again, and twice the crowd gives about twice the rows."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rnd = random.Random(3)
    common = prose(60, rnd)

    def crowd(n):
        texts = [common + " " + " ".join(f"u{rnd.random()}" for _ in range(20)) for _ in range(n)]
        texts += [edited(t.split(), 2, rnd) for t in texts[::10]]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        nodes = spark.createDataFrame([(i, i) for i in range(len(texts))], "node long, comp long")
        rare = neardup._by_rarest(docs, nodes, 4, 80, "doc_id", "text").cache()
        units = neardup._units(neardup._crossing(rare), rare).collect()
        at = defaultdict(set)
        for r in units:
            at[r.bucket, r.i, r.j].add(r.node)
        sets = [shingles(t, 4) for t in texts]
        for i, (a, b) in enumerate((10 * j, n + j) for j in range(n // 10)):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                assert any({a, b} <= m for m in at.values()), i
        return len(units)

    small = crowd(200)
    assert 0 < small and crowd(400) < 3 * small < 3 * 200 * 8


def test_texts_of_one_document_link_it(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(5, a), (9, a), (9, b), (11, b), (9, None), (9, " "), (20, c), (20, d), (20, c), (21, d), (30, ""), (30, None), (31, None), (None, a), (40, "e f")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id is not None)
    want = {5: 5, 9: 5, 11: 5, 20: 20, 21: 20, 30: 30, 31: 31, 40: 40}
    assert got == sorted((i, want[i], want[i] == i) for i, _ in rows if i is not None)


def test_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op7_minhash_neardup(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    hold(rows, texts)


def test_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(100, 130)] + [(i, 7) for i in range(200, 260)] + [(rnd.randrange(300, 500), rnd.randrange(300, 500)) for _ in range(120)]
    links += [(5, 5), (None, 3), (3, None), (101, 100)]
    root = {n: n for e in links if None not in e and e[0] != e[1] for n in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in links:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {n: find(n) for n in root}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
