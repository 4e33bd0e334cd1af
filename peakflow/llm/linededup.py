"""Operator 8: line deduplication by pairwise alignment.

Each line of a document is hashed (128 bits), and each hash is owned by the earliest document that holds it. A document is
paired with the owners of its lines, so a line that many documents share makes one pair for each of them, with its owner,
and never pairs among them. A pair carries the places of the lines that it shares on both sides. The two sequences are
aligned by patience diff: lines that are unique on both sides and lie in the longest common order are anchors, the gaps between them are
aligned in the same way, and where a gap has no unique line its k-th copies count as unique. Aligned lines are deleted from the later
document, however short the block, and the rest is aligned with the whole earlier document again, as moved and doubled
passages align in another round; after ``ROUNDS`` each line that is left is a block by itself. So every line that isn't blank and
that an earlier document holds goes, and `alignments` says which block of which document it repeats.

A blank line goes if it lies between such a line and the next or last one that isn't blank, at the same distance as in
an earlier document: it is hashed with that line and distance. Rows of a hot line meet its owner under as many keys
as its count asks for. Every deleted line stays in an earlier document.

Defined results: earlier means the smaller document id (a null id comes last), then the smaller
content hash; rows that are equal in id and text are one document and are treated alike; a null text has no lines
and stays null; blank lines (white space alone) are alike, and stay if nothing next to them goes; lines repeated within one
document alone stay; an empty table gives an empty one; all other columns are kept as they are.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import lateral
from .base import fresh, ship_code, tidy, written

#: Alignments of a pair before what is left goes line by line.
ROUNDS = 8
BLANK = b" \t\n\x0b\x0c\r"


def _key(id_col: str, text_col: str) -> Column:
    """128 bits that tell documents apart wherever and whenever a task computes them."""
    return F.struct(F.xxhash64(id_col, text_col).alias("a"), F.xxhash64(text_col, F.lit(1), id_col).alias("b"))


def line_items(text: bytes) -> dict[bytes, list[int]]:
    """The places of each hash in a text: a line's own, or those of a blank line with its neighbours."""
    lines = text.split(b"\n")
    items: dict[bytes, list[int]] = {}
    hashes = [xxhash.xxh3_128_digest(x) if x.strip(BLANK) else None for x in lines]
    for order, way in ((range(len(lines)), b"then"), (range(len(lines) - 1, -1, -1), b"next")):
        near = at = None
        for n in order:
            if hashes[n] is not None:
                near, at = hashes[n], n
                if way == b"then":
                    items.setdefault(near, []).append(n)
            elif near is not None:
                items.setdefault(xxhash.xxh3_128_digest(b"%s%d " % (way, abs(n - at)) + near), []).append(n)
    return items


def document_items(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(last, doc_id, a, b, h, h2, places): one row for each different hash of a document."""
    ship_code(docs.sparkSession)
    known = F.col(id_col).cast("long")
    rows = docs.where(F.col(text_col).rlike(r"\S")).select(known.isNull().alias("last"), known.alias("doc_id"), _key(id_col, text_col).alias("key"),
                                                          F.col(text_col).cast("binary").alias("body")).select("last", "doc_id", "key.a", "key.b", "body")

    def run(batches):
        for b in batches:
            at, digests, sizes, places = [], [], [], []
            for i, body in enumerate(b.column(4)):
                items = line_items(body.as_buffer().to_pybytes())
                at += [i] * len(items)
                digests += items
                sizes += map(len, items.values())
                places += [p for ps in items.values() for p in sorted(ps)]
            if not at:
                continue
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(places, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at)) for c in range(4)), pa.array(h[:, 0]), pa.array(h[:, 1]), lists],
                                             names=["last", "doc_id", "a", "b", "h", "h2", "places"])

    return rows.mapInArrow(tidy(run), "last boolean, doc_id long, a long, b long, h long, h2 long, places array<int>")


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of the first, that increases in the second too (patience sorting)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        if k == len(tops):
            tops.append(j)
            at.append(n)
        else:
            tops[k], at[k] = j, n
        back.append(at[k - 1] if k else -1)
    out = []
    n = at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _places(seq: list, lo: int, hi: int) -> dict:
    out: dict = {}
    for n in range(lo, hi):
        out.setdefault(seq[n], []).append(n)
    return out


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Places of equal items that patience diff aligns, in order."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            out.append((i2, j2))
        if i == i2 or j == j2:
            continue
        mine, theirs = _places(a, i, i2), _places(b, j, j2)
        anchors = _increasing(sorted((p[0], theirs[x][0]) for x, p in mine.items() if len(p) == 1 and len(theirs.get(x, ())) == 1))
        if not anchors:  # nothing is unique: the k-th copies are taken for the same line
            out += _increasing(sorted(z for x, p in mine.items() if x in theirs for z in zip(p, theirs[x], strict=False)))
            continue
        for x, y in anchors:
            todo.append((i, x, j, y))
            out.append((x, y))
            i, j = x + 1, y + 1
        todo.append((i, i2, j, j2))
    return sorted(out)


def common_blocks(shared: list[tuple[list[int], list[int]]]) -> list[tuple[int, int, int]]:
    """(start, n, start in the earlier document) of the later document's aligned blocks.

    ``shared`` gives the places of each common item in the later and in the earlier document.
    """
    later = sorted((n, item) for item, (mine, _) in enumerate(shared) for n in mine)
    earlier = sorted((n, item) for item, (_, theirs) in enumerate(shared) for n in theirs)
    b, a = [item for _, item in later], [item for _, item in earlier]
    met: dict[int, int] = {}
    for _ in range(ROUNDS):
        found = align(a, b)
        for i, j in found:
            met.setdefault(later[j][0], earlier[i][0])
        gone = {j for _, j in found}
        later = [x for j, x in enumerate(later) if j not in gone]
        b = [item for _, item in later]
        if not b:
            break
    for n, item in later:  # moved apart: lines by themselves
        met.setdefault(n, shared[item][1][0])
    blocks: list[list[int]] = []
    for n, m in sorted(met.items()):
        if blocks and n == blocks[-1][0] + blocks[-1][1] and m == blocks[-1][2] + blocks[-1][1]:
            blocks[-1][1] += 1
        else:
            blocks.append([n, 1, m])
    return [tuple(x) for x in blocks]


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, doc_id, owner_id, start, n, owner_start): n lines from ``start`` on (from 0) repeat those from ``owner_start`` on in an earlier document.

    ``a`` and ``b`` are the later document's key.
    """
    rows = document_items(docs, id_col, text_col)
    owners = written(rows.groupBy("h", "h2").agg(F.min(F.struct("last", "doc_id", "a", "b", "places")).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1"), "line-owners")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = owners.agg(F.sum("k")).first()[0] or 0
    salts = F.ceil(F.col("k") * parts / max(1, total)).cast("int")
    hot = F.broadcast(owners.where(F.col("k") * parts > total).select("h", "h2", salts.alias("salts")))  # fewer than there are shuffle partitions
    dealt = rows.join(hot, ["h", "h2"], "left").withColumn("salt", F.coalesce(F.pmod(F.col("a"), F.col("salts")), F.lit(0)).cast("int"))
    copied = owners.select("h", "h2", "first", F.explode(F.sequence(F.lit(0), F.when(F.col("k") * parts > total, salts).otherwise(1) - 1)).alias("salt"))
    shared = dealt.select("h", "h2", "salt", "doc_id", "a", "b", "places").join(copied, ["h", "h2", "salt"]).where("a <> first.a OR b <> first.b")
    pairs = shared.groupBy("a", "b", "doc_id", F.col("first.doc_id").alias("owner_id"), F.col("first.a").alias("owner_a"), F.col("first.b").alias("owner_b")).agg(
        F.collect_list(F.struct("places", F.col("first.places").alias("theirs"))).alias("shared"))

    def run(batches):
        for batch in batches:
            at, blocks = [], []
            for i, pair in enumerate(batch.column(4)):
                found = common_blocks([(x["places"], x["theirs"]) for x in pair.as_py()])
                at += [i] * len(found)
                blocks += found
            start, n, owner_start = np.array(blocks, np.int32).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at, pa.int64())) for c in range(4)), *map(pa.array, (start, n, owner_start))],
                                             names=["a", "b", "doc_id", "owner_id", "start", "n", "owner_start"])

    return pairs.select("a", "b", "doc_id", "owner_id", "shared").mapInArrow(tidy(run), "a long, b long, doc_id long, owner_id long, start int, n int, owner_start int")


def deletions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, gone, stays): how many lines a document loses, and the runs of lines that stay, as (start, n); documents that lose none aren't in it."""
    blocks = alignments(docs, id_col, text_col).groupBy("a", "b").agg(F.collect_list(F.struct("start", "n")).alias("blocks"))

    def run(batches):
        for b in batches:
            gone, stays = [], []
            for block in b.column(2):
                lines, at, left = 0, 0, []
                for start, end in sorted((x["start"], x["start"] + x["n"]) for x in block.as_py()):
                    if start > at:
                        left.append({"start": at, "n": start - at})
                    lines += max(0, end - max(at, start))  # a blank line may go with either neighbour
                    at = max(at, end)
                gone.append(lines)
                stays.append([*left, {"start": at, "n": 1 << 30}])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.int64()), pa.array(
                stays, pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])))], names=["a", "b", "gone", "stays"])

    return blocks.mapInArrow(tidy(run), "a long, b long, gone long, stays array<struct<start: int, n: int>>")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gone_col: str = "n_deleted") -> DataFrame:
    """``docs`` with the repeated blocks cut out of the text, and the number of lines that went."""
    key, lost, stays, parts = (fresh(docs, c) for c in ("key", "gone", "stays", "parts"))
    cut = deletions(docs, id_col, text_col).select(F.struct("a", "b").alias(key), F.col("gone").alias(lost), F.col("stays").alias(stays))
    rows = docs.withColumn(key, _key(id_col, text_col)).join(cut, key, "left")
    # Split once for each text that loses lines; every run that stays is one slice.
    rows = lateral(rows, {parts: F.when(F.col(lost).isNotNull(), F.split(F.col(text_col), "\n", -1))})
    kept = F.array_join(F.flatten(F.transform(stays, lambda s: F.slice(F.col(parts), s["start"] + 1, s["n"]))), "\n")
    out = gone_col if gone_col in docs.columns else fresh(docs, gone_col)
    text = F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(kept)
    return rows.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c != out], F.coalesce(F.col(lost), F.lit(0)).cast("long").alias(out))


def op8(spark: SparkSession, docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_lines", F.when(F.col("text") == "", 0).otherwise(F.regexp_count("text", F.lit("\n")) + 1).cast("long"))
    out = dedup_lines(rows)
    return out.select("doc_id", "n_lines", "n_deleted", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"))
