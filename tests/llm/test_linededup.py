import random
import time

from edge_docs import TEXTS, edge_docs, empty_docs, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from peakflow.llm import linededup as ld
from peakflow.llm import queries


def runs(lines):
    """For each line, what makes it go if an earlier document has it: itself, or a blank line's distances from its neighbours."""
    out = []
    for n, x in enumerate(lines):
        if x.strip(" \t\x0b\x0c\r"):
            out.append({x})
            continue
        near = [next((m for m in order if lines[m].strip(" \t\x0b\x0c\r")), None) for order in (range(n - 1, -1, -1), range(n + 1, len(lines)))]
        out.append({(lines[m], side, abs(n - m)) for side, m in enumerate(near) if m is not None})
    return out


def brute(texts):
    """{id: (text, lines deleted)} for texts of distinct ids, without anything of the module."""
    seen, out = set(), {}
    for i, t in sorted(texts.items()):
        lines = [] if t is None else t.split("\n")
        own = runs(lines)
        gone = {n for n, r in enumerate(own) if r & seen}
        out[i] = (None if t is None else "\n".join(x for n, x in enumerate(lines) if n not in gone), len(gone))
        seen.update(*own)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=20), st.lists(st.integers(0, 6), max_size=20))
def test_alignments_are_common_subsequences(a, b):
    got = ld.align(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    assert len(ld.align(a, a)) == len(a)


def places(a, b):
    """What a pair carries, for a later document b and an earlier one a."""
    return [([n for n, y in enumerate(b) if y == x], [n for n, y in enumerate(a) if y == x]) for x in sorted(set(a) & set(b))]


def test_blocks_between_moved_lines():
    """Moved lines are blocks of their own, and short blocks go as well: since a block may be one line long, no length is asked for."""
    assert ld.common_blocks(places([1, 2, 3, 9], [8, 1, 2, 7, 3, 6])) == [(1, 2, 0), (4, 1, 2)]
    assert ld.common_blocks(places([1, 2, 3], [1, 2, 3])) == [(0, 3, 0)]
    assert ld.common_blocks(places([1, 2, 3, 4], [3, 4, 0, 1, 2])) == [(0, 2, 2), (3, 2, 0)]
    assert ld.common_blocks(places([5, 1, 1, 2], [1, 1, 0, 1, 1, 2])) == [(0, 2, 1), (3, 3, 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=20), st.lists(st.integers(0, 6), max_size=20))
def test_blocks_repeat_the_earlier_document_and_leave_nothing_shared(a, b):
    blocks = ld.common_blocks(places(a, b))
    assert all(b[s:s + n] == a[o:o + n] for s, n, o in blocks)
    assert [x for s, n, _ in blocks for x in range(s, s + n)] == [n for n, x in enumerate(b) if x in a]


def test_long_documents_take_linear_time():
    rnd = random.Random(1)
    a = list(range(100_000))
    b = a[:40_000] + [-x for x in range(1, 20_001)] + a[40_000:][::-1]
    begin = time.time()
    assert sum(n for _, n, _ in ld.common_blocks(places_of_distinct(a, b))) == 100_000
    text = "\n".join(rnd.choice(["", "x", f"line {n}"]) for n in range(100_000)).encode()
    assert sum(len(p) for p in ld.line_items(text).values()) >= 100_000
    assert time.time() - begin < 30


def places_of_distinct(a, b):
    at = {x: n for n, x in enumerate(a)}
    return [([n], [at[x]]) for n, x in enumerate(b) if x in at]


def test_long_text_is_cut_in_seconds(spark):
    lines = [f"line {n}" for n in range(100_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(x for n, x in enumerate(lines) if n % 2) + "\nnew\n\n" + "\n".join(reversed(lines)))], "doc_id long, text string")
    begin = time.time()
    got = {r.doc_id: (r.text, r.n_deleted) for r in ld.dedup_lines(docs).collect()}
    assert got == {1: ("\n".join(lines), 0), 2: ("new\n", 150_000)}
    assert time.time() - begin < 60


def test_alignments_name_the_repeated_block(spark):
    docs = spark.createDataFrame([(4, "a\nb\nc\nd"), (9, "x\nb\nc\ny\na"), (11, "b\nc\ny")], "doc_id long, text string")
    got = sorted((r.doc_id, r.owner_id, r.start, r.n, r.owner_start) for r in ld.alignments(docs).collect())
    assert got == [(9, 4, 1, 2, 1), (9, 4, 4, 1, 0), (11, 4, 0, 2, 1), (11, 9, 2, 1, 3)]


def test_passages_go_from_later_documents_only(spark):
    rnd = random.Random(6)
    passage = "\n".join(prose(9, rnd) for _ in range(7))  # over 50 words, in lines that are short
    boiler = "Made with care by a printer in town."
    texts = {i: f"{prose(30, rnd)}\n{boiler}\n{prose(25, rnd)}" for i in range(30)}
    for i in (4, 9, 21):
        texts[i] += "\n" + passage + "\n" + prose(20, rnd)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_deleted) for r in ld.dedup_lines(docs).collect()}
    assert got == brute(texts)
    # The passage goes from 9 and 21, and the line that all hold from all but the first: no length is asked for.
    assert {i: n for i, (_, n) in got.items()} == {i: (i > 0) + 7 * (i in (9, 21)) for i in texts}
    assert got[9] == (texts[9].replace("\n" + passage, "").replace("\n" + boiler, ""), 8)


def test_edge_documents(spark):
    docs = edge_docs(spark)
    rows = ld.dedup_lines(docs).collect()
    assert set(rows[0].asDict()) == set(docs.columns)  # the count takes the place of a column of its name
    want = brute(dict(enumerate(TEXTS)))
    for r in rows:
        if r.doc_id is not None:
            assert (r.text, r.n_deleted) == want[r.doc_id]
    assert want[7] == ("", 1) and sum(r.doc_id == len(TEXTS) - 1 for r in rows) == 2


def test_null_ids_come_last_and_ties_are_settled(spark):
    text = "\n".join(prose(30, random.Random(i)) for i in range(3))
    rows = [(None, text), (None, text + "\nmore"), (3, text), (3, text + "\nother")]
    got = sorted((r.doc_id or 99, r.n_deleted) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(3, 0), (3, 3), (99, 3), (99, 3)]


def test_empty_table(spark):
    assert ld.dedup_lines(empty_docs(spark)).collect() == []


def test_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    want = brute(texts)
    rows = queries.op8_line_dedup(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    assert all((r.n_deleted, r.n_bytes) == (want[r.doc_id][1], len(want[r.doc_id][0].encode())) for r in rows)


def whole(texts):
    """{id: text}: what is left if each line that a smaller id holds goes; for texts without blank lines, and without the module's constants."""
    seen, out = set(), {}
    for i, t in sorted(texts.items()):
        out[i] = "\n".join(x for x in t.split("\n") if x not in seen)
        seen.update(t.split("\n"))
    return out


def test_short_repeated_lines_go(spark):
    rnd = random.Random(12)
    texts = {i: f"{prose(9, rnd)}\nAll rights reserved.\n{prose(12, rnd)}\nOf.\n{prose(5, rnd)}" for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs).collect()}
    assert got == whole(texts) and got[7].count("\n") == 2


def test_table_holds_no_line_twice(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    want = whole(texts)
    got = {r.doc_id: (r.n_lines - r.n_deleted, r.n_bytes) for r in queries.op8_line_dedup(spark, "/root/testdata/sf0.01").collect()}
    lost = {i: t.count("\n") + 1 if t else 0 for i, t in want.items()}
    assert got == {i: (lost[i], len(t.encode())) for i, t in want.items()}


def test_blank_lines_go_with_their_block(spark):
    texts = ["one\n\ntwo\n \nthree", "\nfour\none\n\n\nfive\n\ntwo\n\n", "six\n\nseven", None, "\n\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs).collect()}
    assert got == {0: texts[0], 1: "\nfour\n\nfive\n", 2: texts[2], 3: None, 4: "\n\n"}


def test_shared_blocks_whose_lines_have_other_owners_go(spark):
    rnd = random.Random(13)
    block = [prose(9, rnd) for _ in range(3)]
    texts = {i: f"{prose(20, rnd)}\n{x}\n{prose(20, rnd)}" for i, x in enumerate(block[:2])}
    texts |= {i: "\n".join([prose(20, rnd), *block, prose(20, rnd)]) for i in (5, 8)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs).collect()}
    assert got == whole(texts) and not any(x in got[8] for x in block)


def test_doubled_and_moved_passages_go(spark):
    rnd = random.Random(14)
    p, q, r = (prose(60, rnd) for _ in range(3))
    other = iter([prose(30, rnd) for _ in range(9)])
    texts = [p, [next(other), p, next(other), p, next(other)], [q, next(other), q, next(other), r], [r, next(other), q]]
    texts = {i: t if isinstance(t, str) else "\n".join(t) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x.doc_id: (x.text, x.n_deleted) for x in ld.dedup_lines(docs).collect()}
    assert {i: t for i, (t, _) in got.items()} == whole(texts) and [got[i][1] for i in range(4)] == [0, 2, 0, 2]
