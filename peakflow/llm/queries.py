"""One registered query per operator: applied to its whole table, with production parameters."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path

from ..sources.tables import read_table
from . import bpe, decontam, hardnegs, lexical, linededup, neardup, pii, repeats, secrets, shards, tokcount, topk, toxicity
from .base import documents


def op5_toxicity(spark, sf_dir):
    return toxicity.op5(spark, documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op6_benchmark_decontamination(spark, sf_dir):
    return decontam.op6(spark, documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op7_minhash_neardup(spark, sf_dir):
    return neardup.op7(spark, documents(spark, sf_dir))


def op8_line_dedup(spark, sf_dir):
    return linededup.op8(spark, documents(spark, sf_dir))


def op9_extendible_shards(spark, sf_dir):
    return shards.op9(spark, documents(spark, sf_dir))


def op10_bpe_roundtrip(spark, sf_dir):
    return bpe.op10(spark, documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op1_topk_search(spark, sf_dir):
    return topk.op1(spark, read_table(spark, sf_dir, "embeddings"))


def op2_secret_scan(spark, sf_dir):
    return secrets.op2(spark, documents(spark, sf_dir))


def op3_personal_data(spark, sf_dir):
    return pii.op3(spark, documents(spark, sf_dir))


def op4_token_counts(spark, sf_dir):
    return tokcount.op4(spark, documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op11_lexical_search(spark, sf_dir):
    return lexical.op11(spark, documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op12_repeated_bytes(spark, sf_dir):
    return repeats.op12(spark, documents(spark, sf_dir))


def op13_hard_negatives(spark, sf_dir):
    return hardnegs.op13(spark, read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_secret_scan": op2_secret_scan,
    "op3_personal_data": op3_personal_data,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_minhash_neardup": op7_minhash_neardup,
    "op8_line_dedup": op8_line_dedup,
    "op9_extendible_shards": op9_extendible_shards,
    "op10_bpe_roundtrip": op10_bpe_roundtrip,
    "op11_lexical_search": op11_lexical_search,
    "op12_repeated_bytes": op12_repeated_bytes,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_topk_search": topk.ORACLE,
    "op11_lexical_search": lexical.ORACLE,
    "op13_hard_negatives": hardnegs.ORACLE,
}
