"""Operator 7: MinHash near-duplicates of word shingles.

Each text becomes its set of distinct shingle hashes, and that set ``BANDS`` x ``ROWS`` minima
under universal hash functions. Equal sets are one node from the start, named by their
smallest document id. Nodes that agree in all rows of a band meet in a bucket. No bucket
is expanded into pairs: its best-connected node, the pivot, is paired with the others;
pairs whose signatures agree well enough are verified on their full sets. Buckets whose
other nodes lie in several components after that are compared block by block, one task a pair of
blocks, which gives only links between different components. Where that would copy a bucket's nodes more
often than they have rarest shingles, as for a crowd of texts around one
frequent passage, the bucket is split: its nodes meet again by each of their rarest shingles. Sets of
the wanted similarity share one of those under any common order of the shingles (the prefix
filter), so that the split loses nothing; the order counts the crowds' shingles in
``CELLS`` cells, whose number is fixed. The links' components come from alternating large-star and small-star.

Two sets of similarity 0.8 meet in no bucket with probability below 2e-7. Quadratic is what is left in a rarest shingle
that more than a block of nodes of several components hold: it goes through pairs of blocks, one task a pair.

Defined results: a null text is the empty one; a text without words has no shingle and is
linked with nothing; one with fewer words than a shingle has one shingle; rows with one
document id count as one document, which links all its texts; rows with a null id are linked with nothing and kept;
ties of ids can't change components; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ship_code, tidy, written
from .components import components

BANDS, ROWS = 40, 5
SHINGLE, PERCENT = 4, 80
#: Share of agreeing minima (one byte each) below which sets of the wanted similarity are out of the question: 0.8 less five deviations.
AGREE = 0.65
#: Nodes in a block of a bucket.
BLOCK = 256
#: Cells in which the shingles of crowded buckets are counted, by the first 16 bits of their hashes.
CELLS = 1 << 16

_RANDOM = np.random.default_rng(20240917)
_A = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_MIX = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; words are split at ASCII white space, A-Z lower-cased."""
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    cuts = np.asarray(split.offsets)
    flat = split.values.slice(cuts[0], cuts[-1] - cuts[0])
    cuts = cuts - cuts[0]
    full = np.asarray(pc.binary_length(flat)) > 0  # white space at an end gives an empty word
    coded = flat.dictionary_encode()
    names = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    words = names[np.asarray(coded.indices)][full] if len(flat) else np.empty(0, np.uint64)
    cuts = np.concatenate([[0], np.cumsum(full)])[cuts]
    hashed = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for i in range(k):
        hashed = _scramble(hashed + words[i:len(words) - k + 1 + i] * _MIX[i]) if len(hashed) else hashed
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(hashed[a:b - k + 1]))
        elif b > a:
            h = np.array([b - a], dtype=np.uint64)
            for i in range(a, b):
                h = _scramble(h + words[i:i + 1] * _MIX[k])
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(text, function) minima under the universal hash functions a * x + b of 64 bits; sets must not be empty."""
    out = np.empty((len(sets), len(_A)), np.uint64)
    at = 0
    while at < len(sets):
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= 32_768):  # stays in the cache
            size += len(sets[to])
            to += 1
        flat = np.concatenate(sets[at:to])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:to]])[:-1]])
        buf = np.empty_like(flat)
        for i in range(len(_A)):
            np.multiply(flat, _A[i], out=buf)
            np.add(buf, _B[i], out=buf)
            out[at:to, i] = np.minimum.reduceat(buf, starts)
        at = to
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """(text, band) 64-bit keys; the band's number is part of its key."""
    m = m.reshape(len(m), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[40], m.shape[:2]).copy()
    for r in range(ROWS):
        key = _scramble(key + m[:, :, r] * _MIX[41 + r])
    return key


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, print, bands, sig) of each row: set size, the set's 128-bit fingerprint, band keys, a byte of each minimum."""
    ship_code(docs.sparkSession)

    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(1), k)
            some = [i for i, s in enumerate(sets) if len(s)]
            prints: list = [None] * len(sets)
            bands: list = [None] * len(sets)
            sigs: list = [None] * len(sets)
            if some:
                m = minima([sets[i] for i in some])
                keys = band_keys(m).view(np.int64)
                small = (_scramble(m) & np.uint64(255)).astype(np.uint8)
                for row, i in enumerate(some):
                    prints[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    bands[i], sigs[i] = keys[row], small[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "print", "bands", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(run), "doc_id long, n_shingles long, print binary, bands array<long>, sig binary")


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def _alike(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose signatures agree well enough for the wanted similarity."""
    both = (pairs.join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("a")), "u")
            .join(sigs.select(F.col("node").alias("v"), F.col("sig").alias("b")), "v").select("u", "v", "a", "b"))

    def run(batches):
        for x in batches:
            n = x.num_rows
            if n:
                a, b = (np.frombuffer(b"".join(x.column(i).to_pylist()), np.uint8).reshape(n, -1) for i in (2, 3))
                x = x.filter(pa.array(_agreement(a, b) >= AGREE))
                yield x.select([0, 1])

    return both.mapInArrow(tidy(run), "u long, v long").distinct()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets' similarity reaches ``percent`` hundredths."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _sets(docs: DataFrame, nodes: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(node, items): the packed full sets of the named nodes."""
    wanted = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).join(nodes, "node", "left_semi")

    def run(batches):
        for b in batches:
            items = pa.array([s.tobytes() for s in shingle_sets(b.column(1), k)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), items], names=["node", "items"])

    return wanted.mapInArrow(tidy(run), "node long, items binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("items").alias("a")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("items").alias("b")), "v").select("u", "v", "a", "b"))

    def run(batches):
        for x in batches:
            good = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                    for a, b in zip(x.column(2).to_pylist(), x.column(3).to_pylist(), strict=True)]
            yield x.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(tidy(run), "u long, v long").distinct()


def _units(open_buckets: DataFrame, members: DataFrame) -> DataFrame:
    """(bucket, i, j, node, comp): each node of an open bucket in every pair of blocks that its own block is part of."""
    sized = members.join(open_buckets, "bucket").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    own = sized.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = own.select("bucket", "node", "comp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return other.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "comp")


def _crossing(members: DataFrame) -> DataFrame:
    """(bucket, size) of the buckets whose nodes lie in several components; buckets of the same nodes count once."""
    still = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h"),
                                          F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b")
    return still.groupBy("size", "h").agg(F.min("bucket").alias("bucket")).select("bucket", "size")


def _rarest_of(n: Column, percent: int) -> Column:
    """How many rarest shingles of a set of ``n`` the prefix filter asks for."""
    return F.floor(n * (100 - percent) / 100) + 1


def _shingle_counts(texts: DataFrame, k: int) -> np.ndarray:
    """How many shingles of the texts (node, text) each cell holds."""
    def run(batches):
        total = np.zeros(CELLS, np.int64)
        for b in batches:
            for s in shingle_sets(b.column(1), k):
                cells, n = np.unique(s >> np.uint64(48), return_counts=True)
                total[cells] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["cell", "n"])

    counts = np.zeros(CELLS, np.int64)
    for r in texts.mapInArrow(tidy(run), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r.cell] = r.n
    return counts


def _by_rarest(docs: DataFrame, crowd: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(bucket, node, comp): the nodes of ``crowd`` (node, comp) by each of their rarest shingles, as many as the prefix filter asks for."""
    texts = (docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
             .join(crowd.select("node"), "node", "left_semi"))
    counts = _shingle_counts(texts, k)

    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(1), k)
            first = [len(s) + (-percent * len(s)) // 100 + 1 if len(s) else 0 for s in sets]
            rarest = [s[np.lexsort((s, counts[s >> np.uint64(48)]))[:n]] for s, n in zip(sets, first, strict=True)]
            if sum(first):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rarest).view(np.int64)), pa.array(np.repeat(np.asarray(b.column(0)), first))],
                                                 names=["bucket", "node"])

    return texts.mapInArrow(tidy(run), "bucket long, node long").join(crowd, "node").select("bucket", "node", "comp")


def _likely(units: DataFrame, sigs: DataFrame) -> DataFrame:
    """The units' nodes that may be linked with a node of another component there."""
    grouped = (units.join(sigs.select("node", "sig"), "node").groupBy("bucket", "i", "j")
               .agg(F.collect_list(F.struct("node", "comp", "sig")).alias("m")))
    kind = pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("node", pa.int64()), ("comp", pa.int64())])

    def run(batches):
        for x in batches:
            for r in x.to_pylist():
                m = r["m"]
                sig = np.frombuffer(b"".join(y["sig"] for y in m), np.uint8).reshape(len(m), -1)
                comp = np.array([y["comp"] for y in m])
                keep = [bool(((_agreement(sig[n], sig) >= AGREE) & (comp != comp[n])).any()) for n in range(len(m))]
                got = [y for y, good in zip(m, keep, strict=True) if good]
                if got:
                    yield pa.RecordBatch.from_pylist([{"bucket": r["bucket"], "i": r["i"], "j": r["j"], "node": y["node"], "comp": y["comp"]} for y in got], schema=kind)

    return grouped.mapInArrow(tidy(run), "bucket long, i int, j int, node long, comp long")


def _unit_links(likely: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between components in each unit; nodes that are joined already aren't compared."""
    grouped = likely.join(sets, "node").groupBy("bucket", "i", "j").agg(F.collect_list(F.struct("node", "comp", "items")).alias("m"))

    def run(batches):
        for x in batches:
            for r in x.to_pylist():
                m = [(y["node"], y["comp"], np.frombuffer(y["items"], np.uint64)) for y in r["m"]]
                root = {c: c for _, c, _ in m}

                def find(c):
                    while root[c] != c:
                        c = root[c]
                    return c

                links = []
                for n, (u, cu, a) in enumerate(m):
                    for v, cv, b in m[:n]:
                        if find(cu) != find(cv) and linked(a, b, percent):
                            root[find(cu)] = find(cv)
                            links.append({"u": u, "v": v})
                if links:
                    yield pa.RecordBatch.from_pylist(links)

    return grouped.mapInArrow(tidy(run), "u long, v long").distinct()


def _texts_of_one(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, own, node) of the documents whose rows differ in their sets: the smallest of their nodes, and each of them."""
    differ = (rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce("print", F.lit(b""))).alias("a"), F.max(F.coalesce("print", F.lit(b""))).alias("b"))
              .where("a <> b").select("doc_id"))
    each = written(rows.where("print IS NOT NULL").select("doc_id", "print").join(differ, "doc_id").distinct()
                   .join(nodes.select("print", "node"), "print").select("doc_id", "node").distinct(), "minhash-texts")
    return each.groupBy("doc_id").agg(F.min("node").alias("own")).join(each, "doc_id")


def classes(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row."""
    rows = written(signatures(docs, k, id_col, text_col), "minhash")
    named = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = written(named.groupBy("print").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands"), F.any_value("sig").alias("sig"),
                                               F.max("n_shingles").alias("n_shingles")), "minhash-nodes")
    # Bands whose bucket holds one node alone are dropped before anything else is gathered.
    every = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(every.join(sizes, "bucket"), "minhash-members")
    reach = members.groupBy("node").agg(F.sum("size").alias("reach"))
    pivots = members.join(reach, "node").groupBy("bucket").agg(F.max(F.struct("reach", F.negative("node").alias("n"))).alias("p")).select(
        "bucket", F.negative("p.n").alias("pivot"))
    starred = written(members.join(pivots, "bucket").select("bucket", "size", "node", "pivot"), "minhash-stars")
    pairs = starred.where("node <> pivot").select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v")).distinct()
    alike = written(_alike(pairs, nodes), "minhash-alike")
    wanted = alike.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    several = written(_texts_of_one(rows, nodes), "minhash-several")
    same = several.where("own <> node").select(F.col("own").alias("u"), F.col("node").alias("v")).distinct()
    links = written(_verified(alike, _sets(docs, wanted, k, id_col, text_col), percent).unionByName(same), "minhash-links")
    found = written(components(links), "minhash-components")

    others = (starred.where("node <> pivot").select("bucket", "node").join(found, "node", "left")
              .select("bucket", "node", F.coalesce("component", "node").alias("comp")))
    still = written(_crossing(others), "minhash-open")
    # The cheaper way for each bucket, by how often it copies a node.
    rarest = _rarest_of(F.col("n_shingles"), percent)
    held = (others.join(still, "bucket").join(nodes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "node")
            .groupBy("bucket", "size").agg(F.avg(rarest).alias("rarest")))
    sized = written(held.select("bucket", "size", (F.ceil(F.col("size") / BLOCK) > F.col("rarest")).alias("crowded")), "minhash-sized")
    units = _units(sized.where("NOT crowded").drop("crowded"), others)
    crowd = written(others.join(sized.where("crowded").select("bucket"), "bucket", "left_semi").select("node", "comp").distinct(), "minhash-crowd")
    if not crowd.isEmpty():
        rare = written(_by_rarest(docs, crowd, k, percent, id_col, text_col), "minhash-rare")
        units = units.unionByName(_units(_crossing(rare), rare))
    likely = written(_likely(units, nodes), "minhash-likely")
    if not likely.isEmpty():
        more = _unit_links(likely, _sets(docs, likely.select("node").distinct(), k, id_col, text_col), percent)
        links = written(links.unionByName(more), "minhash-links")
        found = written(components(links), "minhash-components")
    named_by = nodes.select("print", "node").join(found, "node", "left").select("print", F.coalesce("component", "node").alias("component"))
    # Texts without words have no set; they go with their document's other texts, if it has any.
    owners = several.select("doc_id", F.col("own").alias("node")).distinct().join(found, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    plain = rows.select("doc_id", "n_shingles", "print")
    out = (plain.where("print IS NOT NULL").join(named_by, "print", "left").drop("print")
           .unionByName(plain.where("print IS NULL").drop("print").join(owners, "doc_id", "left")))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return classes(docs)
