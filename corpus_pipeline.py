"""A training corpus in five stages, each one of the operators in ``barforge.llm``.

``documents`` goes in; language ID drops what has no recognisable language,
SimHash keeps one document of each group, secrets are replaced in the texts,
sources are mixed to their target weights, and the mix is encoded.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import byte_bpe, langid_ecoc, mix_sources, secret_scan, simhash_ball
from barforge.llm.common import held_out, written

#: Parameters of the pipeline.
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WEIGHTS = [1, 2, 3]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: those without letters
    (``und``) and those without any learned letter.  A language that was null
    is filled in with the prediction; merely ambiguous documents stay."""
    model = langid_ecoc.train(docs.where(~held_out(docs["doc_id"])))
    others = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row")
    told = langid_ecoc.predict(docs, model, keep=[others], with_text=True).where("lang_pred <> 'und' AND learned")
    row = F.col("row")
    return told.select(*[F.col("text") if c == "text" else (F.coalesce(row[c], "lang_pred") if c == "lang" else row[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id
    (rows that repeat it stay too; ids that are null come last)."""
    return simhash_ball.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced in its text; ``n_chars`` follows the text."""
    models = secret_scan.train(secret_scan.labelled_tokens(docs))
    return secret_scan.redact(docs, models).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (never, or up to three times)."""
    return mix_sources.repeat_taken(docs, WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens, n_bytes``: the ids, and the length of what they decode to."""
    ranks = byte_bpe.load_ranks(RANK_FILE)
    decoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, then=byte_bpe.decoding(ranks))
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.octet_length("bytes").cast("long").alias("n_bytes"))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("mix_sources", mix),
    ("byte_bpe", encode),
]

#: SQL can express neither the trained models nor XXH64; tests hold run()
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
