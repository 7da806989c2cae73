"""Registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fjord.llm import (
    blockann, chunkbpe, credentials, exactdup, hardneg, hostrules, linkgraph, mixing, quality, simhash, tokenfiles, toxicity,
    whitening,
)
from fjord.llm.common import ascii_lower, shared_folder, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).drop("__x")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, all_spans = credentials.spans(table(spark, sf_dir, "documents")), F.col("spans")
    count = lambda kind: F.size(F.filter(all_spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(all_spans, lambda s: s["kind"].isin(credentials.STRONG))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in credentials.STRONG],
        F.sha2(credentials.listing(base), 256).alias("base_sha256"), credentials.listing(all_spans).alias("spans"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    written = tokenfiles.write(table(spark, sf_dir, "documents"), folder,
                               public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenfiles.read_back(spark, folder, written)


def op4_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linkgraph.judge(table(spark, sf_dir, "pages"), within=1e-10)
    return out.withColumns({c: F.round(c, 6) for c in ("trust", "distrust")})


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(chunkbpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def bpe_digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blockann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("__x")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), 256)
    out = exactdup.exact_groups(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("doc.doc_id", "source", "lang", "topic", "tokens", F.round("weight", 6).alias("weight"),
                      F.round("p", 6).alias("probability"), "selected")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hostrules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "host", F.round("host_rate", 9).alias("host_rate"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, moved)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_secrets": op2_secrets,
    "op3_token_files": op3_token_files,
    "op4_url_verdicts": op4_url_verdicts,
    "op5_bpe": op5_bpe,
    "op6_nearest": op6_nearest,
    "op7_toxicity": op7_toxicity,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixing": op9_mixing,
    "op10_simhash": op10_simhash,
    "op11_host_rules": op11_host_rules,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}
