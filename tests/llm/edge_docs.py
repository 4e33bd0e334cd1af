"""Documents with every odd case, under column names that operators use inside."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, rid long, key string, words string, ids string, "
          "bucket string, node long, score string, hashes string, gone int, n_deleted string, shard string, terms string")
RND = random.Random(11)
WORDS = [a + b + c for a in ("th", "on", "er", "ki") for b in ("a", "ou", "e") for c in ("nd", "st", "r", "ble")]


def prose(n, rnd=RND):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


LONG = prose(20_000)
TEXTS = [None, "", " ", "\n", "one", "two words", LONG, LONG, "tie text", "tie text", "  lead  and trail  ", "é😀 日本語\x00\x1c",
         "<|endoftext|> <s>", "\n".join(prose(12) for _ in range(30))]


def edge_docs(spark, texts=TEXTS):
    """One row a text, the last row twice, and one row without an id."""
    def row(i, t):
        return (i, t, "en", "s", None if t is None else len(t), 1, "k", "w", "i", "b", 7, "x", "h", 3, "n", "sh", "t")

    rows = [row(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1], row(None, "no id here")], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def with_documents(spark, tmp_path, docs, labels=(), benchmark=()):
    """A folder with documents, labels and benchmark tables."""
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)
