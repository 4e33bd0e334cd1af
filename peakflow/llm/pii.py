"""Operator 3: personal data by fixed patterns and bootstrapped contextual extraction.

The fixed patterns' matches are the seeds. Each seed, and each other token that could be an
identifier (it holds a digit or an at sign), gives edges of a graph between lexical patterns (the
words around it) and instances (its text). Spark scores the graph in rounds: a
pattern's confidence is the mean score of its distinct instances, seeds scoring 1; an
instance's score is the chance that at least one of its confident patterns is right. Tokens in the
context of patterns that end up confident are new spans, of kind ``context``; these are
identifiers whose form no fixed pattern knows.

Defined results: a null text is the empty one and has no spans; repeated rows each give a row, and
add nothing to a pattern's distinct instances; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import ship_code, texts, tidy, written

KINDS = ("email", "ip", "card", "phone", "context")
#: An email's part before the at sign, and what follows it.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: No match of the rule begins within a run of digits, as one from the run's beginning would come first.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A token with a digit or at sign.
TOKEN = re.compile(r"(?<!\S)[^\s\d@]*[\d@]\S*")
WORD = re.compile(r"\S+")
REACH = 64  # characters on either side in which a context's words are looked for

ROUNDS = 3
#: A pattern counts when it has so many distinct instances, and is confident from this mean score on.
SUPPORT, CONFIDENT = 4, 0.6
#: Most that one pattern says for an instance.
TRUST = 0.9


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in time linear in the text.

    Looks back from each at sign, as far as the last sign or match.
    """
    out, low = [], 0
    at = text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        low = m.end() if m else at + 1
        at = text.find("@", low)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns' valid matches, by kind and start."""
    out = [(0, s, e) for s, e in emails(text)]
    if not re.search("[0-9]", text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a span: two words before it; one before and one after it."""
    cut = max(0, start - REACH)
    before = WORD.findall(text[cut:start])
    if cut and before and not text[cut - 1].isspace() and not text[cut].isspace():
        before = before[1:]  # a word that the window cuts
    after = WORD.findall(text[end:end + REACH])
    before, after = ([re.sub(r"\d", "0", w.lower()) for w in x] for x in (before[-2:], after[:1]))
    out = []
    if len(before) == 2:
        out.append(" ".join(before) + " _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int, bool]]:
    """(pattern, instance, start, end, seed) of the fixed spans and of the other tokens that could be identifiers."""
    units = [(s, e, True) for _, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    n = 0
    for m in TOKEN.finditer(text):
        start, end = m.start(), m.end()
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while start < end and not text[start].isalnum():
            start += 1
        while n < len(taken) and taken[n][1] <= start:
            n += 1
        if end - start >= 4 and not any(s < end and start < e for s, e in taken[max(0, n - 4):n + 4]):
            units.append((start, end, False))
    return [(p, text[s:e], s, e, seed) for s, e, seed in units for p in contexts(text, s, e)]


SPAN = "struct<kind:int,start:int,end:int>"
CANDIDATE = "struct<pattern:string,instance:string,start:int,end:int,seed:boolean>"


def found(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, base, candidates) of each row of `base.texts`."""
    ship_code(docs.sparkSession)
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    cand = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_())]))

    def run(batches):
        for b in batches:
            spans, cands = [], []
            for t in b.column(2).to_pylist():
                base = base_spans(t)
                spans.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in base])
                cands.append([dict(zip(("pattern", "instance", "start", "end", "seed"), x, strict=True)) for x in candidates(t, base)]
                             if re.search("[0-9@]", t) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, span), pa.array(cands, cand)],
                                             names=["rid", "doc_id", "base", "candidates"])

    return docs.select("rid", "doc_id", "text").mapInArrow(tidy(run), f"rid long, doc_id long, base array<{SPAN}>, candidates array<{CANDIDATE}>")


def confident_patterns(edges: DataFrame) -> DataFrame:
    """(pattern, confidence, support) of the confident patterns of a graph (pattern, instance, seed)."""
    graph = edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    wide = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= SUPPORT)
    graph = written(graph.join(wide, "pattern").withColumn("score", F.col("seed").cast("double")), "pii-graph")
    patterns = None
    for n in range(ROUNDS):
        patterns = graph.groupBy("pattern", "support").agg(F.avg("score").alias("confidence")).where(F.col("confidence") >= CONFIDENT)
        patterns = written(patterns, "pii-patterns")
        if n < ROUNDS - 1:
            said = (graph.join(patterns.select("pattern", "confidence"), "pattern").groupBy("instance")
                    .agg((1 - F.exp(F.sum(F.log(1 - TRUST * F.col("confidence"))))).alias("told")))
            graph = written(graph.drop("score").join(said, "instance", "left").select(
                "pattern", "instance", "seed", "support", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("told", F.lit(0.0))).alias("score")), "pii-graph")
    return patterns


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, base, spans): arrays of (kind, start, end); ``spans`` adds the contexts' finds to the fixed patterns' ones."""
    rows = written(found(texts(docs, id_col, text_col)), "pii-found")
    each = rows.where(F.size("candidates") > 0).select("rid", F.inline("candidates"))
    patterns = confident_patterns(each.select("pattern", "instance", "seed"))
    new = (each.where("NOT seed").join(patterns.select("pattern"), "pattern").groupBy("rid")
           .agg(F.collect_set(F.struct(F.lit(4).alias("kind"), "start", "end")).alias("new")))
    return rows.join(new, "rid", "left").select("rid", "doc_id", "base", F.concat("base", F.coalesce("new", F.array().cast(f"array<{SPAN}>"))).alias("spans"))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"], m["end"])), ",")


def op3(spark: SparkSession, docs: DataFrame) -> DataFrame:
    got = scan(docs)

    def number(kind):
        return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return got.select("doc_id", *map(number, range(4)), F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
