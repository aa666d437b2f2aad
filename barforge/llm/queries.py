"""The operators bound to the given tables, one query each, with the
parameters of production; every query reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, byte_bpe, hard_negatives, itq_dedup, langid_ecoc, license_scan, merkle_manifest, mix_sources, norm_topk, secret_scan, simhash_ball, suffix_dedup, toxicity_zstd
from .common import held_out

#: Where the rank file lies; its pattern comes with it.
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), min_cosine=0.9)


def op2_toxicity_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_zstd.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    scored = toxicity_zstd.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_langid_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid_ecoc.train(docs.where(~held_out(F.col("doc_id"))))
    out = langid_ecoc.predict(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op5_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_ball.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = secret_scan.train(secret_scan.labelled_tokens(docs))
    found = secret_scan.scan_secrets(docs, models)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(secret_scan.BASE_KINDS)],
                        F.sha2(secret_scan.report(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.report(F.concat("base", "added")).alias("spans"))


def op7_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources.mix_sources(table(spark, sf_dir, "documents"), [1, 2, 3])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(RANK_FILE)
    return byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, then=byte_bpe.digesting(ranks))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    counts = attention_lm.Counts(attention_lm.count_words(docs.where(~held)))
    blank = attention_lm.untrained(counts, byte_bpe.load_ranks(RANK_FILE), public_tokenizers.PATTERN)
    rows = attention_lm.read(docs, counts, blank, held)
    return attention_lm.score_rows(rows, counts, attention_lm.learn(rows.where("not held_out"), counts, blank))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 50 == 0, positives=5, negatives=3, scale=256.0, least=50, most=95)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    stripped = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    out = merkle_manifest.manifest(docs, "source", "doc_id", [*others, text], found=[*others, stripped])
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle_manifest.proof(F.col("path")), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (
    op1_itq_dedup, op2_toxicity_zstd, op3_langid_ecoc, op4_license_scan, op5_simhash_ball, op6_secret_scan, op7_norm_topk,
    op8_mix_sources, op9_byte_bpe, op10_suffix_dedup, op11_attention_lm, op12_hard_negatives, op13_merkle_manifest)}
ORACLE = {"op7_norm_topk": norm_topk.TOPK_SQL, "op8_mix_sources": mix_sources.mix_sql(), "op12_hard_negatives": hard_negatives.MINE_SQL}
