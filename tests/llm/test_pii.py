import hashlib
import random
import re
import time

from edge_docs import TEXTS, edge_docs, empty_docs

from peakflow.llm import pii, queries

HARD = ["mail a.b+c@x-y.example.org, 1.2.3.4 256.1.1.1 1.2.3.4.5", "4111 1111-1111 1111 and 4111111111111112", "+1 (988) 555-2485 +12 +1234567890123456",
        "9" * 6000 + ".1.1.1", "@ @@ a@b a@b.c. x@y.z@w.v", "１２３ ٣٤٥ 12-34"]


def luhn(x):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(x[::-1])) % 10 == 0


def expected(t):
    t = t or ""
    ip_ok = [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(len(x) < 4 and int(x) < 256 for x in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [list(re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)), ip_ok,
             [m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
             [m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]]
    text = ",".join(f"{k}:{m.start()}:{m.end()}" for k, f in zip(pii.KINDS, found, strict=False) for m in f)
    return [len(f) for f in found], text


def hold(rows, text_of):
    for r in rows:
        n, text = expected(text_of(r.doc_id))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == n
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans == text or r.spans.startswith(text) and "context" in r.spans


def test_edge_documents(spark):
    texts = TEXTS + HARD
    rows = pii.op3(spark, edge_docs(spark, texts)).collect()
    assert len(rows) == len(texts) + 2
    hold(rows, lambda i: "no id here" if i is None else texts[i])


def test_empty_table(spark):
    assert pii.op3(spark, empty_docs(spark)).collect() == []


def test_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.op3_personal_data(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    hold(rows, docs.get)


def test_linear_patterns_equal_the_rules():
    rnd = random.Random(3)
    for n in range(20_000):
        t = "".join(rnd.choice("a1.@-_ +%9") for _ in range(rnd.randrange(1, 40)))
        got = [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(t)]
        assert ",".join(f"{k}:{s}:{e}" for k, s, e in got) == expected(t)[1], t
    old = re.compile(r"(?<![^\s(\[\"'<])[^\s\d@]*[\d@]\S*")
    for n in range(20_000):
        t = "".join(rnd.choice("a1([<@\"'. \n-") for _ in range(rnd.randrange(1, 30)))
        assert [m.span() for m in pii.TOKEN.finditer(t)] == [m.span() for m in old.finditer(t)], t


def test_long_runs_take_linear_time():
    n = 1_000_000
    for t in ["a" * n + " x@y", "a" * n + "@", "7" * n, "(" * n + " 1", "1." * (n // 2), "a@" * (n // 2), "x@y." * (n // 4), "+1" * (n // 2), "-" * n + "@b.c",
              "1 " * (n // 2), "+1" + "(" * n, "a@b.c." * (n // 6), ".".join("9" * 1000 for _ in range(n // 1000))]:
        start = time.process_time()
        pii.candidates(t, pii.base_spans(t))
        assert time.process_time() - start < 5, t[:10]


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    texts = [f"please write to the address user{i}@host{i}.example.com for news" for i in range(8)]
    texts += [f"please write to the address agent-{i}77 for news" for i in range(2)]
    texts += [f"in the year {1900 + i} it rained" for i in range(20)]
    # a second generation: a context that shares only found instances and seeds with the first
    texts += [f"kindly reach staff agent-{i}77 at once" for i in range(2)] + [f"kindly reach staff user{i}@host{i}.example.com at once" for i in range(2)]
    texts += ["kindly reach staff Q9-XYZ at once"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.op3(spark, docs).collect()}
    assert got[8] == got[9] == "context:28:37"
    assert all(got[i] == "" for i in range(10, 30))
    assert got[34] == "context:19:25"


def test_scores_are_those_of_the_graph(spark):
    edges = [("p", f"s{i}", True) for i in range(3)] + [("p", "x", False), ("p", "x", False)] + [("q", "x", False), ("q", "s0", False)] * 2
    edges += [("q", f"y{i}", False) for i in range(2)] + [("rare", "s1", True)]
    got = {r.pattern: (r.confidence, r.support) for r in pii.confident_patterns(spark.createDataFrame(edges, "pattern string, instance string, seed boolean")).collect()}
    graph = {("p", "s0"): 1, ("p", "s1"): 1, ("p", "s2"): 1, ("p", "x"): 0.0}
    conf = 0.75
    for _ in range(pii.ROUNDS - 1):
        graph["p", "x"] = 1 - (1 - pii.TRUST * conf)
        conf = sum(graph.values()) / 4
    assert set(got) == {"p"} and got["p"][1] == 4 and abs(got["p"][0] - conf) < 1e-9
