"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are dealt by range into buckets of similar length, longest first, and
packed.  The bucket of the longest vectors gives every query a first threshold
(its k-th best score there).  Against any other bucket a query is skipped if
even its longest vector cannot reach the threshold; else the threshold and the
bucket's length give a local cosine threshold: a high one prunes by the
query's strongest coordinate, a low one by length (a prefix of the bucket).
What remains is verified by the exact integer product.

Queries travel in blocks, once per group of buckets, and every pair of blocks
answers with at most k rows a query.  Components are whole numbers (see
``quantise``); products are exact, and saturate beyond 64 bits.

Defined results: vectors that are null or hold null or non-finite components
take no part; components of any finite magnitude count, and products beyond 64
bits saturate; vectors of different lengths are not compared; rows that carry
the query's own id are no candidates; repeated rows are candidates each, and
repeated query rows give one answer; a query without candidates gives no row;
an empty table gives an empty result.  Labels and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .vectors import packed, sorted_groups

#: Vectors of a bucket, queries of a block, buckets of a group.
BUCKET = 2048
QUERY_BLOCK = 512
GROUP = 16
#: Local cosine threshold from which coordinates prune.
COORDINATE = 0.7
LIMIT = 1 << 53
#: Lengths count as no more than this.  A longer vector's product with any other
#: that is not zero may pass every 64-bit threshold, and so does the bound.
LONGEST = 1e100


def quantise(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), as whole numbers in float64; what passes the largest
    of these becomes it."""
    with np.errstate(over="ignore"):
        whole = np.floor(scale * x)
    return np.clip(whole, -np.finfo(np.float64).max, np.finfo(np.float64).max)


def lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows, ``LONGEST`` at most."""
    return np.minimum(np.linalg.norm(np.clip(x, -LONGEST, LONGEST), axis=-1), LONGEST)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` and ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < LIMIT:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(v) for v in r] for r in a], dtype=object) @ np.array([[int(v) for v in r] for r in b], dtype=object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def pack_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Runs of equal ``dim`` of the sorted rows, ``size`` at a time:
    ``dim, top, ids, data`` with the largest length of the block."""
    names = ["dim", "top", "ids", "data"]

    def block(rows: pa.RecordBatch) -> pa.RecordBatch:
        norms = rows.column(1).to_numpy()
        return pa.RecordBatch.from_arrays([rows.column(0).slice(0, 1), pa.array([float(norms.max())]),
                                           pa.array([rows.column(2).to_numpy().astype("<i8").tobytes()]),
                                           pa.array([b"".join(rows.column(3).to_pylist())])], names=names)

    for group in sorted_groups(batches, 1):
        for at in range(0, group.num_rows, size):
            yield block(group.slice(at, size))


def top_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def search_block(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query place, candidate ids, scores), at most k of each query that
    reach its floor.  Rows of ``x`` are sorted by length, longest first."""
    q_len, x_len = lengths(q), lengths(x)
    slack = 1e-9
    reach = q_len * (x_len[0] if len(x_len) else 0.0) * (1 + slack) + slack >= floor
    local = np.where(q_len > 0, floor / np.maximum(q_len * max(x_len[0] if len(x_len) else 0.0, 1e-300), 1e-300), -1.0)
    plain = np.flatnonzero(reach & (local < COORDINATE))
    for at in range(0, len(plain), 64):
        some = plain[at:at + 64]
        # Length pruning: no query of the block needs more than this prefix.
        need = np.min(floor[some] / np.maximum(q_len[some], 1e-300)) if (floor[some] > 0).all() else 0.0
        n = int(np.searchsorted(-x_len, -need * (1 - slack) + slack, side="right")) if need > 0 else len(x)
        for place, scores in zip(some.tolist(), products(q[some], x[:n]), strict=True):
            yield place, ids[:n], scores
    unit = None
    for place in np.flatnonzero(reach & (local >= COORDINATE)).tolist():
        unit = x / np.maximum(x_len, 1e-300)[:, None] if unit is None else unit
        u, t = q[place] / q_len[place], min(1.0, local[place])
        f = int(np.argmax(np.abs(u)))
        width = np.sqrt(max(0.0, 1 - u[f] ** 2)) * np.sqrt(max(0.0, 1 - t * t)) + 1e-6
        # Coordinate pruning: at cosine t or more, the coordinate is that near.
        least = u[f] * t - width if u[f] >= 0 else -1.0
        most = u[f] * t + width if u[f] < 0 else 1.0
        n = int(np.searchsorted(-x_len, -(floor[place] / q_len[place]) * (1 - slack) + slack, side="right"))
        some = np.flatnonzero((unit[:n, f] >= least - 1e-9) & (unit[:n, f] <= most + 1e-9))
        yield place, ids[some], products(q[place][None], x[some])[0]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row with ``is_query`` (a
    condition on ``vec_id``) its k best other rows."""
    spark = vectors.sparkSession
    valid = packed(vectors, id_col, vec_col).where("ok AND vec_id IS NOT NULL")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [quantise(np.frombuffer(v), scale) for v in batch.column(2).to_pylist()]
            norms = pa.array([float(lengths(r)) for r in rows], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(1), norms, batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             names=["dim", "norm", "vec_id", "x"])

    rows = written(valid.mapInArrow(whole, "dim int, norm double, vec_id long, x binary"), "topk-rows")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("dim"), F.col("norm").desc(), F.col("vec_id")]

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        return written(dealt.mapInArrow(lambda b: pack_blocks(b, size), "dim int, top double, ids binary, data binary"), name)

    n_groups = max(1, rows.count() // (BUCKET * GROUP))
    buckets = blocks(rows, BUCKET, "topk-buckets").withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(n_groups)).cast("int"))
    queries = blocks(rows.where(is_query).dropDuplicates(["vec_id", "x"]), QUERY_BLOCK, "topk-queries")

    def unpack(dim: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        own = np.frombuffer(ids, "<i8")
        return own, np.frombuffer(data).reshape(len(own), dim)

    def first_floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = []
            for dim, q_ids, q_data, ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (qi, q), (xi, x) = unpack(dim, q_ids, q_data), unpack(dim, ids, data)
                floor = np.full(len(qi), -np.inf)
                for place, scores in enumerate(products(q, x)):
                    other = scores[xi != qi[place]]
                    if len(other) >= k:
                        floor[place] = np.partition(other, len(other) - k)[len(other) - k]
                floors.append(floor.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(floors, pa.binary())], names=["dim", "q_ids", "q_data", "floor"])

    # One bucket a dimension, copied to every task's share of the queries.
    longest = buckets.groupBy("dim").agg(F.max_by(F.struct("ids", "data"), "top").alias("b")).select(
        "dim", "b.ids", "b.data", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("share"))
    asked = queries.select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int").alias("share"))
    asked = asked.join(longest, ["dim", "share"]).select("dim", "q_ids", "q_data", "ids", "data")
    asked = written(asked.mapInArrow(first_floor, "dim int, q_ids binary, q_data binary, floor binary"), "topk-floors")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, q_ids, q_data, floor, ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (qi, q), (xi, x) = unpack(dim, q_ids, q_data), unpack(dim, ids, data)
                out: tuple[list, list, list, list] = ([], [], [], [])
                for place, found, scores in search_block(q, qi, np.frombuffer(floor), x, xi, k):
                    other = found != qi[place]
                    found, scores = found[other], scores[other]
                    best = top_of(scores, found, k)
                    out[0].extend([int(qi[place])] * len(best))
                    out[1].extend([q[place].tobytes()] * len(best))
                    out[2].extend(found[best].tolist())
                    out[3].extend(scores[best].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
                                                 names=["query_id", "q", "vec_id", "score"])

    # The stated queries, in blocks, go once to every group of buckets.
    asked = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    pairs = asked.join(buckets, ["dim", "group"]).select("dim", "q_ids", "q_data", "floor", "ids", "data")
    found = pairs.mapInArrow(answer, "query_id long, q binary, vec_id long, score long").withColumn("q", F.sha2("q", 256))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: DuckDB twin: queries are ids divisible by 50, five best of each.
TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON len(q.e) = len(x.e) AND q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
