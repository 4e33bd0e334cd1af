import random

import corpus_pipeline as cp
from edge_docs import edge_docs, empty_docs, prose, with_documents

from peakflow.llm.base import documents, written


def test_stages_take_effect_in_order(spark, tmp_path):
    rnd = random.Random(3)
    item = prose(40, rnd)
    texts = [prose(150, rnd) for _ in range(120)]
    toxic = set(range(0, 120, 5))
    for i in toxic:
        words = texts[i].split()
        for _ in range(4):
            words[rnd.randrange(len(words))] = rnd.choice(["zorgish", "vleckt"])
        texts[i] = " ".join(words)
    near = texts[11].split()
    near[5:7] = ["changed", "words"]
    passage = prose(60, rnd)
    rows = dict(enumerate(texts))
    rows[200] = texts[12]  # an exact copy
    rows[201] = " ".join(near)  # a near copy
    rows[202] = f"{prose(30, rnd)} {item} {prose(30, rnd)}"
    rows[203] = f"{prose(40, rnd)}\n{passage}"
    rows[204] = f"{passage}\n{prose(45, rnd)}"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows.items()], "doc_id long, text string, lang string, source string, n_chars long")
    base = with_documents(spark, tmp_path, docs, [(i, 1, int(i in toxic)) for i in range(120)], [(1, item)])
    left, by_stage = documents(spark, base), {}
    for name, stage in cp.STAGES:
        got = stage(spark, left, base)
        if name != "bpe":
            assert got.columns == docs.columns
        left = written(got, "test-stage")
        by_stage[name] = {r.doc_id: r.asDict() for r in left.collect()}
    clean = set(rows) - toxic
    assert set(by_stage["toxicity"]) == clean
    assert set(by_stage["line_dedup"]) == clean - {200}
    assert by_stage["line_dedup"][204]["text"] == rows[204].split("\n")[1]
    assert by_stage["line_dedup"][204]["n_chars"] == len(rows[204].split("\n")[1])
    assert all(by_stage["line_dedup"][i]["text"] == rows[i] for i in clean - {200, 204})
    assert set(by_stage["near_dedup"]) == clean - {200, 201}
    assert set(by_stage["decontamination"]) == clean - {200, 201, 202}
    final = {r.doc_id: r.ids_sha256 for r in cp.run(spark, base).collect()}
    assert final == {i: r["ids_sha256"] for i, r in by_stage["bpe"].items()} and set(final) == clean - {200, 201, 202}


def test_edge_and_empty_documents(spark, tmp_path):
    docs = edge_docs(spark)
    left = docs
    base = with_documents(spark, tmp_path / "a", docs, [(3, 1, 0)], [(1, None)])
    for name, stage in cp.STAGES[:-1]:
        left = written(stage(spark, left, base), "test-stage")
        assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert 7 not in ids and 9 not in ids and {0, 1, 2, 3, 4, 5, 6, 8, None} <= set(ids)
    assert cp.run(spark, with_documents(spark, tmp_path / "b", empty_docs(spark))).collect() == []


def test_registered_queries(spark):
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {"pipeline"} <= names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
