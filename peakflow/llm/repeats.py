"""Operator 12: removal of repeated byte strings by a distributed difference-cover suffix sort.

A byte goes if a string of ``window`` bytes covers it that also starts earlier. Texts are read once and cut into
cells: runs of window starts that share the least-hashed gram of their windows (`suffixes.cells`). Equal windows always
lie in cells of one gram, so the suffixes are distributed by gram, and equal cells become one name:
all starts of a cell go if an earlier cell is equal to it (128 bits, the gram's and the cell's hash). What is left
to sort are the texts of grams that several different cells hold, once each. Spark deals them by gram; a task
ranks the suffixes of its texts by the difference cover of 3 (triples are sorted and named, names ranked by recursion,
the other suffixes merged in) and compares the first bytes of neighbours, so its decisions are on the bytes themselves.
Each group of equal windows keeps its earliest start.

Grams that a hundredth of a sample of documents hold are dealt by document first, so no task reads all rows of a hot
passage, and what is left of them is dealt by gram again. A gram with more than ``CELLS`` different cells is not sorted in
one task: its windows are grouped by 128 bits of their bytes.

Defined results: earlier means the smaller document id (a null id counts as the largest long), then a hash
of the text, then the start; rows equal in id and text are one document and are treated alike; matches never
cross documents; a null text is empty; texts shorter than the window keep all bytes; an empty
table gives an empty one; other columns are kept. The bytes that stay need not be whole characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import fresh, hash_sample, ship_code, tidy, written
from .suffixes import cells, repeated_starts

WINDOW, GRAM = 100, 32
#: Documents of the sample that finds hot grams, and the share of them that makes one; it decides where rows go, not what comes out.
SAMPLE_DOCS, HOT_SHARE = 2000, 0.01
#: Most different cells of one gram that one task sorts.
CELLS = 8_000
#: Bytes from which a batch of texts is sorted (with a gram's cells far from the 2^21 that names may have), and rows that are passed on at once.
SORT_BYTES, BATCH_CELLS = 1 << 19, 100_000
LAST = (1 << 63) - 1
CELL = "g long, f long, id long, tie long, start int, n int"


def _key(id_col: str, text_col: str) -> list[Column]:
    known = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    return [known.alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), known).alias("tie")]


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))


def _cells(bodies: DataFrame, window: int, gram: int) -> DataFrame:
    """One row a cell: its gram's hash, its own hash, its document, first start and number of starts."""
    def out(parts):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=NAMES[:6])

    def run(batches):
        for b in batches:
            parts, size = [], 0
            for doc, tie, body in zip(*(np.asarray(c) for c in b.columns[:2]), b.column(2), strict=True):
                for g, f, start, n in cells(body.as_buffer(), window, gram):
                    parts.append((g, f, np.full(len(g), doc), np.full(len(g), tie), start.astype(np.int32), n.astype(np.int32)))
                    size += len(g)
                    if size >= BATCH_CELLS:
                        yield out(parts)
                        parts, size = [], 0
            if parts:
                yield out(parts)

    return bodies.mapInArrow(tidy(run), CELL)


def _hot(bodies: DataFrame, window: int, gram: int) -> list[int]:
    """Grams of ``HOT_SHARE`` of the sampled documents: ``1 / HOT_SHARE`` times the grams of a document at most."""
    found = _cells(hash_sample(bodies, F.col("tie"), SAMPLE_DOCS), window, gram).select("g", "id", "tie").distinct()
    return [r[0] for r in found.groupBy("g").count().where(F.col("count") >= HOT_SHARE * SAMPLE_DOCS).select("g").collect()]


#: What a cell is: a repeat of an earlier equal cell; the first of its kind in a gram of several kinds; the only kind of its gram.
AGAIN, OPEN, ALONE = 0, 1, 2
NAMES = ["g", "f", "id", "tie", "start", "n", "salt", "what"]


def _settle(rows: DataFrame) -> DataFrame:
    """What each cell is among those of its gram and salt; rows that are equal altogether count once.

    A task reads its rows in order and remembers the last one and the only kind so far, so a gram may have any number of rows.
    """
    def told(b, what):
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(np.asarray(what, np.int32))], names=NAMES)

    def run(batches):
        last, kinds, held = None, 0, None  # the last row, how many kinds its gram had, and the first cell of an only kind
        for b in batches:
            if not b.num_rows:
                continue
            g, f, doc, tie, start, _, salt = (np.asarray(c) for c in b.columns)
            before = last or (None,) * 7
            last = tuple(c[-1] for c in (g, f, doc, tie, start, start, salt))

            def changes(*columns):
                return np.concatenate([[any(before[i] is None or before[i] != c[0] for i, c in columns)],
                                       np.any([c[1:] != c[:-1] for _, c in columns], axis=0)])

            new_gram = changes((0, g), (6, salt))
            new_kind = new_gram | changes((1, f))
            new_cell = new_kind | changes((2, doc), (3, tie), (4, start))
            gram = np.cumsum(new_gram) - int(new_gram[0])
            if new_gram[0]:
                if held is not None:
                    yield told(held, [ALONE])
                kinds, held = 0, None
            count = np.bincount(gram[new_kind], minlength=gram[-1] + 1)
            count[0] += kinds
            if held is not None and (count[0] > 1 or gram[-1] > 0):
                yield told(held, [OPEN if count[0] > 1 else ALONE])
                held = None
            what = np.where(new_kind, np.where(count[gram] > 1, OPEN, ALONE), AGAIN)
            kinds = int(count[-1])
            sent = np.flatnonzero(new_cell)
            if kinds == 1 and (new_kind & (gram == gram[-1])).any():  # another kind may follow
                at = np.flatnonzero(new_kind)[-1]
                held = b.slice(int(at), 1)
                sent = sent[sent != at]
            yield told(b.take(pa.array(sent)), what[sent])
        if held is not None:
            yield told(held, [ALONE])

    dealt = rows.repartition("g", "salt").sortWithinPartitions("g", "salt", "f", "id", "tie", "start")
    return dealt.mapInArrow(tidy(run), CELL + ", salt int, what int")


def _texts(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(g, id, tie, start, n, body) of the wanted cells."""
    per_doc = wanted.groupBy("id", "tie").agg(F.collect_list(F.struct("g", "start", "n")).alias("cells"))
    both = docs.join(per_doc, ["id", "tie"]).select("id", "tie", "body", "cells")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                cell = b.column(3).slice(i, 1).flatten()
                body, start, n = b.column(2)[i].as_buffer().to_pybytes(), np.asarray(cell.field("start")), np.asarray(cell.field("n"))
                bodies = pa.array([body[s:s + k + window - 1] for s, k in zip(start.tolist(), n.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([cell.field("g"), *(pa.array(np.full(len(n), np.asarray(b.column(c))[i])) for c in (0, 1)),
                                                  cell.field("start"), cell.field("n"), bodies], names=["g", "id", "tie", "start", "n", "body"])

    return both.mapInArrow(tidy(run), "g long, id long, tie long, start int, n int, body binary")


def _later(cell: np.ndarray, place: np.ndarray, group: np.ndarray, doc: list[np.ndarray], start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, place, n): runs of starts that lie behind the earliest one of their group."""
    at = np.stack([*(d[cell] for d in doc), start[cell] + place])
    order = np.lexsort((*at[::-1], group))
    head = np.concatenate([np.ones(1, bool), group[order][1:] != group[order][:-1]])[:len(order)]
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = order[(at[:, order] != at[:, first]).any(axis=0)]
    later = later[np.lexsort((place[later], cell[later]))]
    c, p = cell[later], place[later]
    head = np.flatnonzero(np.concatenate([np.ones(1, bool), (c[1:] != c[:-1]) | (p[1:] != p[:-1] + 1)])[:len(c)])
    return c[head], p[head], np.diff(np.append(head, len(c)))


def _sorted_repeats(texts: DataFrame, window: int) -> DataFrame:
    """Starts whose windows occur earlier among the texts of their gram: (id, tie, start, n)."""
    def sort(b: pa.RecordBatch):
        doc, start, n = [np.asarray(b.column(c)) for c in ("id", "tie")], np.asarray(b.column("start")), np.asarray(b.column("n"))
        c, p, k = _later(*repeated_starts(b.column("body").to_pylist(), n, window), doc, start)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[0][c], doc[1][c], (start[c] + p).astype(np.int32), k.astype(np.int32))],
                                          names=["id", "tie", "start", "n"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size < SORT_BYTES:
                continue
            both = pa.concat_batches(held)
            g = np.asarray(both.column("g"))
            ends = np.flatnonzero(g[1:] != g[:-1]) + 1
            if len(ends):  # the last gram may go on
                yield sort(both.slice(0, int(ends[-1])))
                both = both.slice(int(ends[-1]))
            held, size = [both], both.nbytes
        if held:
            yield sort(pa.concat_batches(held))

    return texts.repartition("g").sortWithinPartitions("g").mapInArrow(tidy(run), "id long, tie long, start int, n int")


def _grouped_repeats(texts: DataFrame, window: int) -> DataFrame:
    """The same for grams of too many cells: windows are rows, grouped by two hashes of their bytes."""
    one = texts.select("id", "tie", "body", "start", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    one = one.withColumn("w", F.substring("body", F.col("i") + 1, F.lit(window))).select(
        F.xxhash64("w").alias("h"), F.xxhash64(F.lit(1), "w").alias("h2"), F.struct("id", "tie", (F.col("start") + F.col("i")).alias("start")).alias("at"))
    first = one.groupBy("h", "h2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    return one.join(first, ["h", "h2"]).where("at > first").select("at.id", "at.tie", "at.start", F.lit(1).alias("n"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, tie, start, n): the window starts, in runs of n, whose windows start earlier too."""
    ship_code(docs.sparkSession)
    bodies = _bodies(docs, id_col, text_col)
    hot = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(_hot(bodies, window, gram), np.int64)))
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def salted(batches):
        for b in batches:
            g = np.asarray(b.column(0))
            salt = np.where(np.isin(g, hot.value), 1 + np.asarray(b.column(3)).view(np.uint64) % np.uint64(salts), 0) if len(hot.value) else np.zeros(len(g))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(salt.astype(np.int32))], names=NAMES[:7])

    rows = _cells(bodies, window, gram).mapInArrow(tidy(salted), CELL + ", salt int")
    settled = written(_settle(rows).where((F.col("what") != ALONE) | (F.col("salt") > 0)), "repeat-cells")
    # What is left of hot grams, a cell of each kind and salt, meets again by gram.
    again = _settle(settled.where((F.col("what") != AGAIN) & (F.col("salt") > 0)).select(*NAMES[:6], F.lit(0).alias("salt")))
    again = written(again.where(F.col("what") != ALONE), "repeat-cells-hot")
    still = settled.where((F.col("what") == AGAIN) | (F.col("salt") == 0)).unionByName(again)
    wanted = still.where(F.col("what") == OPEN)
    crowded = written(wanted.groupBy("g").count().where(F.col("count") > CELLS).select("g"), "crowded-grams")
    texts = _texts(bodies, wanted, window)
    out = still.where(F.col("what") == AGAIN).select("id", "tie", "start", "n")
    if crowded.isEmpty():
        return out.unionByName(_sorted_repeats(texts, window))
    texts = written(texts, "repeat-texts")
    return (out.unionByName(_sorted_repeats(texts.join(crowded, "g", "left_anti"), window))
            .unionByName(_grouped_repeats(texts.join(crowded, "g", "left_semi"), window)))


def _spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as maximal runs; intervals that touch are one run."""
    if not len(start):
        return start, end
    order = np.argsort(start)
    start, far = start[order], np.maximum.accumulate(end[order])
    head = np.concatenate([[True], start[1:] > far[:-1]])
    return start[head], far[np.append(np.flatnonzero(head)[1:], len(start)) - 1]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   kept_col: str = "kept", spans_col: str = "spans") -> DataFrame:
    """``docs`` with the bytes that stay (binary) and the removed byte spans, array<struct<start, end>>."""
    found = repeated_windows(docs, id_col, text_col, window, gram)
    per_doc = found.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    own, keys = [c for c in docs.columns if c not in (kept_col, spans_col)], {}
    for c in ("id", "tie", "body", "runs"):
        keys[c] = fresh(docs, f"{c}_of_repeats")
    rows = docs.select(*own, *[c.alias(keys[n]) for c, n in zip(_key(id_col, text_col), ("id", "tie"), strict=True)],
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(keys["body"]))
    both = rows.join(per_doc.withColumnsRenamed(keys), [keys["id"], keys["tie"]], "left").select(*own, keys["body"], keys["runs"])
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*docs.select(*own).schema.fields, T.StructField(kept_col, T.BinaryType()), T.StructField(spans_col, span)])

    def run(batches):
        for b in batches:
            kept, starts, ends, cuts = [], [], [], [0]
            for i in range(b.num_rows):
                body, runs = b.column(len(own))[i].as_buffer().to_pybytes(), b.column(len(own) + 1).slice(i, 1).flatten()
                s = np.asarray(runs.field("start"))
                s, e = _spans(s, s + np.asarray(runs.field("n")) + window - 1)
                kept.append(b"".join(body[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(body)], strict=True)) if len(s) else body)
                starts.append(s.astype(np.int32))
                ends.append(e.astype(np.int32))
                cuts.append(cuts[-1] + len(s))
            if not kept:
                continue
            spans = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(np.concatenate(starts)), pa.array(np.concatenate(ends))], names=["start", "end"]))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(own)], pa.array(kept, pa.binary()), spans], names=[*own, kept_col, spans_col])

    return both.mapInArrow(tidy(run), schema)


def op12(spark: SparkSession, docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = remove_repeats(rows).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
