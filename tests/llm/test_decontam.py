import random
import re

from edge_docs import edge_docs, empty_docs, prose

from peakflow.llm import decontam, queries

ITEM = "On Monday a shop in Delft sold 12 apples to Anna and 5 pears to Bert so how much did Anna pay when 1 kg costs 3 euros"


def frames(spark, texts, items):
    return (spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
            spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))


def result(spark, texts, items):
    return sorted((r.doc_id, r.item_id, r.exact) for r in decontam.contaminated(*frames(spark, texts, items)).collect())


def test_copies_and_new_parameters(spark):
    swapped = ITEM.replace("12", "47").replace("Anna", "Zora").replace("Bert", "Carl").replace("Delft", "Gouda").replace("kg", "lb")
    inconsistent = swapped.replace("did Zora", "did Mia")  # two slots of many are breached; the rest covers the item
    texts = [ITEM, f"{prose(50)} {swapped} {prose(50)}", f"{prose(9)} {inconsistent}", f"{prose(7)}. {ITEM.upper()}", prose(300),
             ITEM.replace("On Monday a", "On, Monday a")]
    got = result(spark, texts, [ITEM, prose(40, random.Random(9))])
    assert (0, 0, True) in got and (1, 0, False) in got and (2, 0, False) in got and (5, 0, True) in got
    assert not any(d == 4 for d, _, _ in got)


def test_every_place_and_part_is_found(spark):
    rnd = random.Random(8)
    items = [prose(n, rnd) for n in (9, 15, 30, 60)]
    texts = [" ".join([*prose(k, rnd).split(), items[k % 4], *prose(11, rnd).split()]) for k in range(40)]
    texts += [" ".join(items[3].split()[:45]), " ".join(items[3].split()[:20])]
    got = result(spark, texts, items)
    assert [(d, i) for d, i, _ in got] == [(k, k % 4) for k in range(40)] + [(40, 3)]


def test_breached_slots_are_unmatched(spark):
    """Equal numbers of an item may become different ones; a text whose slots are all breached and its words few isn't the item."""
    twelve = "Anna has 12 red apples and Bert has 12 green pears so how many more fruits do they need to fill a basket of 40 places today?"
    fewer = "12 12 12 12 12 12 12 12 12 12 and then so on it goes"
    texts = [twelve.replace("12 red", "5 red").replace("12 green", "7 green"), " ".join([*map(str, range(50, 60)), *fewer.split()[10:]])]
    assert [(d, i) for d, i, _ in result(spark, texts, [twelve, fewer])] == [(0, 0)]


def test_edge_documents(spark):
    items = [None, "", "short one", "1 2 3 4 5 6 7 8 9 10 11 12", ITEM]
    bench = spark.createDataFrame([*enumerate(items), (4, ITEM), (None, ITEM)], "item_id long, text string").selectExpr("*", "1 AS item", "2 AS tokens")
    docs = edge_docs(spark, [None, "", ITEM, "1 2 3 4 5 6 7 8 9 10 11 12 13", ITEM + "\n" + ITEM])
    rows = decontam.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id or -1, r.n_matched) for r in rows) == [
        *[(2, i, len(ITEM.split())) for i in (-1, 4)], (3, 3, 12), *[(4, i, len(ITEM.split())) for i in (-1, 4)]]
    clean = decontam.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in clean.collect()) == [-1, 0, 1]


def test_empty_tables(spark):
    docs, bench = frames(spark, [ITEM], [ITEM])
    assert decontam.contaminated(empty_docs(spark), bench).collect() == []
    assert decontam.contaminated(docs, bench.limit(0)).collect() == []


def test_table_against_brute_force(spark):
    base = "/root/testdata/sf0.01"
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    docs = {r.doc_id: f" {' '.join(words(r.text))} " for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    items = {r.item_id: " ".join(words(r.text)[1:-1]) for r in spark.read.parquet(f"{base}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.op6_benchmark_decontamination(spark, base).collect()}
    assert whole and whole <= got
    for d, i in got - whole:  # at most some words differ
        have = set(docs[d].split())
        assert sum(w in have for w in items[i].split()) >= decontam.COVER * len(items[i].split()) - 2


def test_short_and_edited_items_are_found_at_every_place(spark):
    rnd = random.Random(21)
    items = [prose(n, rnd) for n in (3, 6, 7, 8, 40)] + ["Is 4 + 5 * 6 equal to 34 or 35 ?"]
    edited = items[4].split()
    for k in range(7, 40, 8):  # every 8th word
        edited[k] = "changed"
    parts = [*items[:4], " ".join(edited), items[5]]
    want = [(8 * k + at, k) for k in range(6) for at in range(8)]
    texts = [" ".join([*prose(at, rnd).split(), parts[k], *prose(9, rnd).split()]) for k in range(6) for at in range(8)]
    got = {(d, i) for d, i, _ in result(spark, texts, items)}
    assert set(want) <= got and not any(i > 0 and i != d // 8 for d, i in got)


def test_coinciding_parameters_signs_and_edits(spark):
    items = ["Tom has 3 apples and 4 pears in a basket so how many fruits are there",
             "Add 12, then 12 again to the sum that the clerk wrote down before lunch"]
    texts = [items[0].replace("3", "5").replace("4", "5"), items[1].replace("12,", "12"), items[1].replace("12 again", "13 again"),
             items[1].replace("12,", "7").replace("12 again", "8 again")]
    docs, bench = frames(spark, [f"{prose(9)}. {t} {prose(9)}" for t in texts], items)
    got = {(r.doc_id, r.item_id): (r.n_tokens - r.n_matched, r.exact) for r in decontam.contaminated(docs, bench).collect()}
    # 12 became 7 and 8: both slots are unmatched, all else is the item's.
    assert got == {(0, 0): (0, False), (1, 1): (0, True), (2, 1): (1, False), (3, 1): (2, False)}
