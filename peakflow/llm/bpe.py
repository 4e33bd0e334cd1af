"""Operator 10: BPE encoding and decoding through a distinct-word table.

The words of all texts are split and counted in Spark (`word_table`); each distinct word
is encoded once. The table's most frequent words, at most ``TABLE_WORDS`` of at most
``WORD_BYTES`` bytes each, go to every task; a batch's words are dictionary-encoded, joined
to the table once per distinct word, and the ids are put back by position. Words outside
that bounded part (most occur once in the corpus and aren't in the table) are encoded where they stand, once per
batch, so that nothing has to be shuffled by position and no word is left out.
Decoding joins the ids to the pieces of the vocabulary.

Defined results: a null text is the empty one, which has no ids; repeated rows are each
encoded; the strings of added tokens (such as ``<|endoftext|>``) inside a text give those
tokens' ids, as the tokenizer does by default; ids that the vocabulary lacks decode to nothing;
an empty table gives an empty one; other columns are kept as they are.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import fresh, ship_code, tidy, written

TABLE_WORDS = 200_000
WORD_BYTES = 48
#: Rows whose words are joined at once.
SLICE_ROWS = 250

WS = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The byte-level split: clitics, letters, numbers, other signs, white space (its last character goes to what follows).
SPLIT = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+")


def ship(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file (a few MB, fixed) to every executor; returns its name there."""
    ship_code(spark)
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


@lru_cache(maxsize=4)
def _tokenizer(name: str):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(SparkFiles.get(name))
    t.no_truncation()
    t.no_padding()
    return t


def added_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


def split_words(text: Column, special: list[str]) -> Column:
    """The words of a text in order, with the strings of added tokens as words of their own."""
    plain = F.regexp_extract_all(text, F.lit(SPLIT), F.lit(0))
    if not special:
        return plain
    either = "|".join("\\Q" + s + "\\E" for s in sorted(special, key=len, reverse=True))
    parts = F.split(text, f"(?={either})|(?<={either})", -1)
    cut = F.flatten(F.transform(parts, lambda s: F.when(s.isin(*special), F.array(s)).otherwise(
        F.regexp_extract_all(s, F.lit(SPLIT), F.lit(0)))))
    return F.when(F.regexp_like(text, F.lit(either)), cut).otherwise(plain)


def encode_words(words: pa.Array, name: str) -> list[np.ndarray]:
    got = _tokenizer(name).encode_batch_fast(words.to_pylist(), add_special_tokens=False)
    return [np.asarray(e.ids, dtype="<u4") for e in got]


def word_table(docs: DataFrame, tokenizer: str, text_col: str = "text", least: int = 1) -> DataFrame:
    """(word, n, ids): each distinct word that the texts hold ``least`` times, its occurrences, and its ids packed as little-endian uint32."""
    spark = docs.sparkSession
    special, name = added_tokens(tokenizer), ship(spark, tokenizer)
    words = (docs.select(F.explode(split_words(F.coalesce(F.col(text_col), F.lit("")), special)).alias("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))

    def encode(batches):
        for b in batches:
            ids = [x.tobytes() for x in encode_words(b.column(0), name)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], names=["word", "n", "ids"])

    return words.mapInArrow(tidy(encode), "word string, n long, ids binary")


def _frequent(table: DataFrame) -> tuple[pa.Array, pa.Array]:
    """The words that go to every task; their number and length are bounded, whatever the corpus.

    A histogram of the words' counts (in eighths of a power of two, so of a few hundred bars) says which counts
    ``TABLE_WORDS`` leave room for.
    """
    short = table.where(F.octet_length("word") <= WORD_BYTES).withColumn("bar", F.floor(8 * F.log2("n")).cast("int"))
    room, least = TABLE_WORDS, 1 << 30
    for bar, n in sorted(map(tuple, short.groupBy("bar").count().collect()), reverse=True):
        room -= n
        if room < 0:
            break
        least = bar
    top = short.where(F.col("bar") >= least).select("word", "ids").toArrow()
    return top["word"].combine_chunks().cast(pa.string()), top["ids"].combine_chunks().cast(pa.binary())


def _ragged(starts: np.ndarray, lens: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """pool[starts[i] : starts[i] + lens[i]] for all i, end to end."""
    ends = np.cumsum(lens)
    at = np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)
    return pool[at]


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of a buffer, cut at ``ends`` (in items)."""
    cuts = np.concatenate([[0], ends]).astype("<i8") * flat.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(flat))])


def _encode_batch(words: pa.Array, table: pa.Array, table_ids: pa.Array, name: str) -> pa.Array:
    cuts = np.asarray(words.offsets)
    flat = words.values.slice(cuts[0], cuts[-1] - cuts[0]) if len(words) else words.values
    cuts = cuts - cuts[0]
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.cast(pa.string())
    hit = pc.index_in(distinct, value_set=table)
    ids = table_ids.take(hit)
    rest = np.flatnonzero(np.asarray(hit.is_null()))
    own = encode_words(distinct.take(pa.array(rest)), name) if len(rest) else []
    offs = np.frombuffer(ids.buffers()[1], "<i4", len(ids) + 1) // 4
    pool = np.frombuffer(ids.buffers()[2] or b"", "<u4")
    starts, lens = offs[:-1].astype(np.int64), np.diff(offs).astype(np.int64)
    lens[rest] = [len(x) for x in own]
    starts[rest] = len(pool) + np.cumsum(lens[rest]) - lens[rest]
    pool = np.concatenate([pool, *own]) if own else pool
    at = np.asarray(coded.indices)
    out = _ragged(starts[at], lens[at], pool) if len(at) else np.empty(0, "<u4")
    total = np.concatenate([[0], np.cumsum(lens[at])]) if len(at) else np.zeros(1, np.int64)
    return _binary(out, total[cuts[1:]])


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col``: the ids of each text, packed as little-endian unsigned 32-bit integers.

    ``decoded_col`` adds their text as `decode` gives it, in the same pass.
    """
    spark = docs.sparkSession
    special, name = added_tokens(tokenizer), ship(spark, tokenizer)
    table = spark.sparkContext.broadcast(_frequent(written(word_table(docs, tokenizer, text_col, least=2), "bpe-words")))
    words_col = fresh(docs, "words")
    kept = [c for c in docs.columns if c not in (ids_col, decoded_col)]
    added = [ids_col] + [decoded_col] * bool(decoded_col)
    cols = docs.select(*kept, split_words(F.coalesce(F.col(text_col), F.lit("")), special).alias(words_col))
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(ids_col, T.BinaryType()),
                           *[T.StructField(c, T.StringType()) for c in added[1:]]])

    def run(batches):
        known, known_ids = table.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                ids = _encode_batch(b.column(b.num_columns - 1), known, known_ids, name)
                new = [ids.cast(pa.binary())] + [_decode_batch(ids, name).cast(pa.string())] * (len(added) - 1)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], names=[*kept, *added])

    return cols.mapInArrow(tidy(run), schema)


def _bytes_of_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces(path: str) -> list[bytes]:
    """The bytes of each id of the vocabulary."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    names = {i: s for s, i in j["model"]["vocab"].items()} | {t["id"]: t["content"] for t in j["added_tokens"]}
    sign = _bytes_of_signs()
    full = re.compile("[" + re.escape("".join(sign)) + "]*")
    out = [b""] * (max(names, default=-1) + 1)
    for i, s in names.items():
        out[i] = bytes(sign[c] for c in s) if full.fullmatch(s) else s.encode()
    return out


@lru_cache(maxsize=4)
def _pieces(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = pieces(SparkFiles.get(name)) + [b""]
    lens = np.array([len(x) for x in own])
    return np.cumsum(lens) - lens, lens, np.frombuffer(b"".join(own), np.uint8)


def _decode_batch(ids: pa.Array, name: str) -> pa.Array:
    starts, lens, pool = _pieces(name)
    ids = ids.cast(pa.large_binary()).fill_null(b"")
    cuts = np.frombuffer(ids.buffers()[1], "<i8", len(ids) + 1 + ids.offset)[ids.offset:] // 4
    flat = np.frombuffer(ids.buffers()[2] or b"", "<u4")[cuts[0]:cuts[-1]].astype(np.int64)
    flat = np.minimum(flat, len(lens) - 1)
    n = lens[flat]
    total = np.concatenate([[0], np.cumsum(n)])
    raw = _binary(_ragged(starts[flat], n, pool) if len(flat) else np.empty(0, np.uint8), total[cuts[1:] - cuts[0]])
    try:
        return raw.cast(pa.large_string())
    except pa.ArrowInvalid:  # bytes that are no text
        return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.large_string())


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of the packed ids, special tokens included."""
    name = ship(df.sparkSession, tokenizer)
    kept = [c for c in df.columns if c != text_col]
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(text_col, T.StringType())])
    at = kept.index(ids_col)

    def run(batches):
        for b in batches:
            text = _decode_batch(b.column(at), name)
            yield pa.RecordBatch.from_arrays([*b.columns, text.cast(pa.string())], names=[*kept, text_col])

    return df.select(*kept).mapInArrow(tidy(run), schema)


def op10(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    both = encode(docs.select("doc_id", "text"), tokenizer, decoded_col="decoded").drop("text")
    return both.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
