"""Embedding near-dedup by iterative quantisation.

A rotation learned on a bounded sample turns vectors into 64-bit codes (signs
of the rotated components); the codes are cut into bands, and a multi-index
Hamming table per band brings together vectors whose band differs in at most
two bits: each vector is filed under its own band value and all its one-bit
neighbours, so such pairs meet in the middle.  What meets is reranked with the
original vectors by cosine in double precision.

Equal vectors are one node with a number of copies, whatever that number.  A
bucket holding more than ``BLOCK`` nodes is dealt into chunks, and each pair
of chunks is a task of its own, so every pair is met and no group lands in one
task.  A pair that meets in several buckets counts in one of them, named by
its codes alone; buckets report sums and local components, never pairs.

Defined results: null and zero vectors, and those with null or non-finite
components, link with nothing and are their own component; vectors of
different lengths never link; repeated rows are copies of each other; vectors
of any finite magnitude are compared (each is first scaled by a power of two,
which cosine does not see); an empty table gives an empty result.  Labels and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, written
from .vectors import hash_share, matrix, packed, sorted_groups

CODE_BITS = 64
BANDS = 4
WIDTH = CODE_BITS // BANDS
#: Vectors, in expectation, that the rotation is learned on.
SAMPLE = 8192
ROUNDS = 40
#: Nodes of a bucket (or a chunk of it) that one step compares.
BLOCK = 512


def random_rotation(dim: int, columns: int, seed: int = 7) -> np.ndarray:
    """dim x columns, orthonormal in blocks of ``dim`` columns."""
    rng = np.random.default_rng([seed, dim])
    blocks = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-columns // dim))]
    return np.hstack(blocks)[:, :columns]


def learn_rotation(sample: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """dim x CODE_BITS projection: principal directions, rotated so that the
    codes are near the rotated points (alternating signs and a Procrustes
    step).  Directions are taken from the origin, as cosine does.  A dimension
    under CODE_BITS is filled up with random rotations of the same space."""
    dim = sample.shape[1]
    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    bits = min(dim, CODE_BITS)
    _, directions = np.linalg.eigh(unit.T @ unit)
    basis = directions[:, ::-1][:, :bits]
    v = unit @ basis
    r = random_rotation(bits, bits)
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    return np.hstack([basis @ r, random_rotation(dim, CODE_BITS - bits)]) if bits < CODE_BITS else basis @ r


def codes_of(unit: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """64-bit codes as signed longs."""
    return np.packbits(unit @ projection >= 0, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def meeting_bucket(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The one bucket (band * 2^WIDTH + value) in which the pair counts: in the
    first band at most two bits apart, the smallest value within one bit of
    both; -1 where no band is that near."""
    out = np.full(len(a), -1, dtype=np.int64)
    a, b = a.view(np.uint64), b.view(np.uint64)
    for band in range(BANDS - 1, -1, -1):
        shift = np.uint64(WIDTH * band)
        x = ((a >> shift) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
        y = ((b >> shift) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
        d = x ^ y
        n = np.bitwise_count(d)
        low = d & -d
        value = np.where(n == 0, x, np.where(n == 1, np.minimum(x, y), np.minimum(x ^ low, y ^ low)))
        out = np.where(n <= 2, (band << WIDTH) + value, out)
    return out


def links_in_bucket(batch: pa.RecordBatch, min_cosine: float) -> tuple[list, list, list]:
    """(nodes, copies linked, local root) of one bucket's chunk pair."""
    dim, bucket, c1, c2 = (batch.column(k)[0].as_py() for k in range(4))
    chunk = batch.column(4).to_numpy()
    node, copies, code = (batch.column(k).to_numpy() for k in (5, 6, 7))
    x = matrix(batch.column(8), dim)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    if c1 == c2:
        i, j = np.nonzero(np.triu(x @ x.T >= min_cosine - 1e-9, 1))
    else:
        left, right = np.flatnonzero(chunk == c1), np.flatnonzero(chunk == c2)
        i, j = np.nonzero(x[left] @ x[right].T >= min_cosine - 1e-9)
        i, j = left[i], right[j]
    if not len(i):
        return [], [], []
    own = meeting_bucket(code[i], code[j]) == bucket
    i, j = i[own], j[own]
    exact = np.einsum("ij,ij->i", x[i], x[j]) >= min_cosine
    i, j = i[exact], j[exact]
    if not len(i):
        return [], [], []
    links = np.zeros(len(node), dtype=np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    root = node.copy()
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if (root == before).all():
            break
    some = links > 0
    return node[some].tolist(), links[some].tolist(), root[some].tolist()


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding",
                    sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    spark = vectors.sparkSession
    rows = packed(vectors, id_col, vec_col, to_unit_range=True)
    zero = F.regexp_replace(F.hex("vec"), "00000000000000(00|80)", "") == ""
    rows = rows.select("vec_id", "dim", F.when(F.col("ok") & ~zero, F.col("vec")).alias("vec"))
    rows = written(rows.withColumn("key", F.sha2("vec", 256)), "itq-rows")
    nodes = written(rows.where("vec IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("vec").alias("vec")), "itq-nodes")

    n = nodes.count()
    drawn = nodes.where(hash_share("key", sample / max(1, n))).select("dim", "vec").toArrow()
    learned = {}
    for dim in set(drawn["dim"].to_pylist()):
        own = drawn.filter(pa.compute.equal(drawn["dim"], dim))["vec"].combine_chunks()
        learned[dim] = learn_rotation(matrix(own, dim))
    shared = spark.sparkContext.broadcast(learned)  # one projection per dimension in the sample

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for dim, vec in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                projection = shared.value.get(dim)
                if projection is None:
                    projection = random_rotation(dim, CODE_BITS)
                out.append(codes_of(np.frombuffer(vec)[None], projection)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "code"])

    coded = written(nodes.select("node", "copies", "dim", "vec").mapInArrow(code, "node long, copies long, dim int, vec binary, code long"), "itq-codes")
    flips = F.array(*[F.lit(m) for m in [0, *(1 << b for b in range(WIDTH))]])
    filed = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.transform(
        flips, lambda m: band * (1 << WIDTH) + (F.call_function("shiftright", F.col("code"), band * WIDTH).bitwiseAND((1 << WIDTH) - 1).cast("int")).bitwiseXOR(m))))
    places = coded.select("dim", F.explode(filed).alias("bucket"), "node", "copies", "code", "vec")
    # BANDS x 2^WIDTH buckets a dimension: a table of bounded size.
    chunks = written(places.groupBy("dim", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks")).where("chunks > 1"), "itq-chunks")
    dealt = (places.join(chunks, ["dim", "bucket"], "left")
             .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("dim", "bucket", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"),
                     "chunk", "node", "copies", "code", "vec"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for group in sorted_groups(batches, 4):
            if group.num_rows > 1:
                for a, b in zip(out, links_in_bucket(group, min_cosine), strict=True):
                    a.extend(b)
            if len(out[0]) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["node", "links", "root"])
                out = ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["node", "links", "root"])

    keys = ["dim", "bucket", "c1", "c2"]
    met = written(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "node long, links long, root long"), "itq-links")
    roots = connected_components(met.select(F.col("node").alias("a"), F.col("root").alias("b")), "itq-components")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    found = nodes.select("key", "node", "copies").join(links, "node", "left").join(roots, "node", "left").select(
        "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    out = rows.select("vec_id", "key").join(found, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
