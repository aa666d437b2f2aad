"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints that differ in at most 2r bits share a value at most r bits from
both, so every distinct fingerprint emits all its variants within r bits, the
variants are shuffled, and fingerprints that meet at a variant are verified.
All that meet at one variant lie within r bits of it, so one link from the
smallest of them to each of the others connects exactly what all their pairs
would, and a group holds at most the ball's size, whatever the input.

Copies share a fingerprint and are one node.  Null and empty texts have
fingerprint zero and are linked like any other; repeated rows keep their
rows; an empty table gives an empty result.  Extra columns are ignored.

``keep_one`` keeps one document of each group: the smallest id with, of the
group's texts under it, the one with the least hash.  Rows that repeat that
document (same id, same text) stay; an id that also heads another group keeps
nothing here.  Null ids come last, and as null names no document, a group that
has no other id keeps exactly one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import connected_components, written

#: The contract of the query and of the pipeline's stage.
SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Shingles whose bits are counted at once, to bound memory on long texts.
CHUNK = 65_536


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash (as a signed long) of the ASCII-lower-cased text's
    k-word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)]
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        block = np.array(hashes[i:i + CHUNK], dtype=">u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits).view(">u8")[0].astype(np.uint64).astype(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, keep: list[Column] = ()) -> DataFrame:
    """``doc_id, <keep>, fp`` for every row."""
    narrow = docs.select(docs[text_col].alias("text"), docs[id_col].cast("long").alias("doc_id"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), k) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps, pa.int64())], names=[*batch.schema.names[1:], "fp"])

    return narrow.mapInArrow(run, StructType(narrow.schema.fields[1:]).add("fp", "long"))


def ball_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: links that connect all distinct ``fp`` at most ``max_bits``
    (an even number) apart, each verified."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: the ball's radius is half of it")
    masks = [0]
    for r in range(1, max_bits // 2 + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(64), r)]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    ball = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.col("fp").bitwiseXOR(m))
    # Dealt before they grow: a fingerprint becomes one row a variant.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = fps.select("fp").repartition(parts, "fp").select("fp", F.explode(ball).alias("v"))
    # A window holds what meets at one variant: at most the ball's size.
    least = F.min("fp").over(Window.partitionBy("v"))
    links = variants.withColumn("least", least).where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def with_roots(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` (one row per fp) with ``root``, one of its group's fps."""
    roots = connected_components(ball_links(distinct, max_bits), "simhash-links")
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest id among all
    documents reachable over links of at most ``max_bits`` bits."""
    rows = written(fingerprints(docs, id_col, text_col, k), "simhash-rows")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = written(with_roots(distinct, max_bits), "simhash-groups")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    member = linked.join(ids, "root").select("fp", "component_id")
    return rows.join(member, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that hold the kept document of their group."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")  # no column of the input can clash
    # Rows without an id get numbers, fixed by being written; others are named by id and text.
    nameless = docs[id_col].cast("long").isNull()
    numbered = written(docs.where(nameless).select(row, F.monotonically_increasing_id().alias("number")), "simhash-nameless")
    rows = docs.where(~nameless).select(row, F.lit(-1).cast("long").alias("number")).unionByName(numbered)
    doc_id = F.col("row")[id_col].cast("long")
    key = [doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"), F.xxhash64(F.col("row")[text_col]).alias("hash"), F.col("number")]
    keyed = rows.select(doc_id.alias("doc_id"), F.col("row")[text_col].alias("text"), *key)
    names = ["none", "id", "hash", "number"]
    fps = written(fingerprints(keyed, k=k, keep=[keyed[c] for c in names]).select("fp", *names), "simhash-rows")
    least = F.min(F.struct(*names)).alias("least")
    linked = written(with_roots(fps.groupBy("fp").agg(least), max_bits), "simhash-groups")
    kept = linked.groupBy("root").agg(F.min("least").alias("least")).select("least.*")
    return rows.select("row", *key).join(kept, names, "left_semi").select("row.*")
