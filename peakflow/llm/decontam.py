"""Operator 6: benchmark decontamination by template canonicalisation, from DataFrame functions alone.

Texts and benchmark items become token templates: numbers, names (capitalised words inside a
sentence) and units turn into typed placeholders, other words lose case and punctuation.
Windows of ``WINDOW`` template tokens are hash-joined, all windows of an item with all windows of a
document, so each shared run of WINDOW tokens meets; an item of fewer tokens is one window of its whole length.
Documents' windows are first held against the benchmark's hashes alone (broadcast if they are few enough),
so only real hits are shuffled. A hit fixes where the item would lie in the document; there
the templates are compared token by token, and the slots must be consistent: one
value of the item, signs around it and case aside, stands for one value of the document (two values may become one).
An item's value that the document holds at one place and has changed at another is an edit, and counts as
matched only where it is the item's own; slots whose value was replaced by several others count as unmatched. A
document holds an item if its matched places are the ``COVER``-th part of the item's tokens or more, so copies
and re-parameterised questions are found, and chance windows aren't.

Defined results: a null text is the empty one; documents without a hit have no row; rows equal in
id and text count once; windows of placeholders alone are no evidence, but items of nothing
else are looked up by their raw values; a null document id gives rows with a null id;
items equal in id and text count once; empty tables give an empty one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import fresh, written

WINDOW = 6
COVER = 0.6
#: The most window hashes of the benchmark that are broadcast (80 MB); more are left to Spark's own joins.
SENT_HASHES = 5_000_000

NUMBER = r"(?<![\p{L}\p{N}])[-+$€£]?\p{N}(?:[\p{N}.,:/-]*\p{N})?"
NAME = r"(?<=[\p{Ll}\p{N},;:] )\p{Lu}[\p{Ll}'-]+"
UNITS = ("mm", "cm", "m", "km", "mi", "miles", "mile", "ft", "feet", "inches", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml",
         "s", "sec", "seconds", "min", "minutes", "hour", "hours", "day", "days", "week", "weeks", "year", "years",
         "%", "percent", "usd", "eur", "dollars", "euros", "cents", "mph", "km/h", "gb", "mb", "kb", "hz", "v", "w", "kw")
SIGNS = ".,;:!?\"'()[]{}«»“”‘’…*&#$_-"


def raw_tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")


def template(text: Column) -> Column:
    """Tokens with typed placeholders, one for each of `raw_tokens`."""
    typed = F.regexp_replace(F.regexp_replace(text, NUMBER, "<num>"), NAME, "<name>")

    def canonical(x):
        word = F.translate(x, SIGNS, "")
        return F.when(word.isin(*UNITS), F.lit("<unit>")).when(word == "", x).otherwise(word)

    return F.transform(raw_tokens(F.lower(typed)), canonical)


def _is_slot(x: Column) -> Column:
    return x.isin("<num>", "<name>", "<unit>")


def windows(tokens: Column, size: Column | int, kind: str = "") -> Column:
    """array<struct<at, h>>: hashes of the windows of ``size`` tokens at every place; windows of different kinds never meet."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.size(tokens) >= size, F.sequence(F.lit(0), F.size(tokens) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(*([F.lit(kind)] if kind else []), F.slice(tokens, i + 1, size)).alias("h")))


def _key(id_col: Column | str, text_col: Column | str) -> Column:
    return F.struct(F.xxhash64(id_col, text_col).alias("a"), F.xxhash64(text_col, F.lit(1), id_col).alias("b"))


def _bare(raw: Column) -> Column:
    """A value without its case and the signs around it; 1.5 isn't 15, and -3 isn't 3."""
    bare = F.rtrim(F.ltrim(F.lower(raw), F.lit(SIGNS.replace("-", ""))), F.lit(SIGNS))
    return F.when(bare == "", raw).otherwise(bare)


def _hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, item, place): where an item would begin in a document, going by shared windows."""
    some = items.where(F.size("tokens") > 0).withColumns({
        "size": F.least(F.size("tokens"), F.lit(WINDOW)), "plain_item": F.exists("tokens", lambda x: ~_is_slot(x)), "raw": F.transform("values", _bare)})
    plain = F.exists(F.slice("tokens", F.col("at") + 1, F.col("size")), lambda x: ~_is_slot(x))
    templates = some.where("plain_item").select("item", "size", "tokens", F.inline(windows(F.col("tokens"), F.col("size")))).where(plain)
    # Items of placeholders alone go by their raw values.
    raws = some.where("NOT plain_item").select("item", "size", F.inline(windows(F.col("raw"), F.col("size"), "raw"))).withColumn("size", -F.col("size"))
    known = written(templates.select("item", "size", "at", "h").unionByName(raws.select("item", "size", "at", "h")), "benchmark-windows")
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())  # 2 x WINDOW of them at most; raw ones are below 0
    raw_values = [F.transform(raw_tokens(F.col("text")), _bare).alias("raw")] if any(n < 0 for n in sizes) else []
    every = F.flatten(F.array(*[windows(F.col("tokens"), n) if n > 0 else windows(F.col("raw"), -n, "raw") for n in sizes or [WINDOW]]))
    hashes = known.select("h").distinct()
    if hashes.count() <= SENT_HASHES:
        hashes = F.broadcast(hashes)
    seeds = (docs.select("key", template(F.col("text")).alias("tokens"), *raw_values).select("key", F.explode(every).alias("w"))
             .select("key", F.col("w.at").alias("i"), F.col("w.h").alias("h")).join(hashes, "h", "left_semi"))
    return seeds.join(known, "h").select("key", "item", (F.col("i") - F.col("at")).alias("place")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, doc_id, item_id, n_matched, n_tokens, n_slots, exact) of each document that holds a benchmark item.

    ``key`` is a 128-bit hash of the document's id and text, ``n_slots`` counts the placeholders at the item's matched places, ``exact`` says that every
    value in them is the item's own.
    """
    items = written(benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct()
                    .select(F.struct(F.xxhash64("item_id", "text").alias("a"), F.col("item_id").alias("id")).alias("item"),
                            raw_tokens(F.col("text")).alias("values"), template(F.col("text")).alias("tokens")), "benchmark-items")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "key", _key("doc_id", "text"))
    hits = written(_hits(rows, items), "benchmark-hits")
    wanted = hits.select("key").distinct()
    held = rows.join(wanted, "key").select("key", "doc_id", raw_tokens(F.col("text")).alias("values"), template(F.col("text")).alias("tokens"))
    both = (held.join(hits, "key").join(items.select("item", F.col("values").alias("item_values"), F.col("tokens").alias("item_tokens")), "item"))
    # Places of the item that lie inside the document and hold the same template token there.
    at = F.filter(F.sequence(F.lit(0), F.size("item_tokens") - 1), lambda j: (F.get("item_tokens", j) == F.get("tokens", F.col("place") + j)))
    placed = both.select("key", "doc_id", "item", F.size("item_tokens").alias("n_tokens"), "item_tokens", "item_values", "values", "place", at.alias("at"))
    def value(column, j):
        return _bare(F.get(column, j))

    slots = F.transform(F.filter("at", lambda j: _is_slot(F.get("item_tokens", j))), lambda j: F.struct(
        j.alias("j"), value("item_values", j).alias("mine"), value("values", F.col("place") + j).alias("theirs")))
    placed = placed.select("key", "doc_id", "item", "n_tokens", "at", slots.alias("slots"))
    # What each value of the item became, apart from itself; and the values that are kept somewhere.
    kept = F.array_distinct(F.transform(F.filter("slots", lambda s: s["mine"] == s["theirs"]), lambda s: s["mine"]))
    new = F.array_distinct(F.transform(F.filter("slots", lambda s: s["mine"] != s["theirs"]), lambda s: F.struct(s["mine"].alias("mine"), s["theirs"].alias("theirs"))))
    placed = placed.withColumns({"kept": kept, "new": new})
    swapped = F.transform(F.filter("new", lambda s: ~F.array_contains(F.col("kept"), s["mine"])), lambda s: s["mine"])
    breached = F.filter(F.array_distinct("swapped"), lambda x: F.size(F.filter("swapped", lambda y: y == x)) > 1)
    placed = placed.withColumn("swapped", swapped).withColumn("breached", breached)
    unmatched = F.transform(F.filter("slots", lambda s: (s["mine"] != s["theirs"]) & (F.array_contains("kept", s["mine"]) | F.array_contains("breached", s["mine"]))), lambda s: s["j"])
    checked = placed.select("key", "doc_id", "item", "n_tokens", F.array_except("at", unmatched).alias("at"), "slots", F.size("slots").alias("n_slots"))
    whole = checked.groupBy("key", "doc_id", "item", "n_tokens").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n_matched"), F.max("n_slots").alias("n_slots"),
        F.bool_and(F.forall("slots", lambda s: s["mine"] == s["theirs"])).alias("exact"))
    return whole.where(F.col("n_matched") >= COVER * F.col("n_tokens")).select(
        "key", "doc_id", F.col("item.id").alias("item_id"), "n_matched", "n_tokens", "n_slots", "exact").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    key = fresh(docs, "key")
    bad = contaminated(docs, benchmark, id_col, text_col).select(F.col("key").alias(key)).distinct()
    own = _key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    return docs.withColumn(key, own).join(bad, key, "left_anti").select(*docs.columns)


def op6(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).drop("key")
