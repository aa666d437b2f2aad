"""Hard-negative mining with exact scores from a residue-number-system GEMM.

Components are whole numbers (see ``quantise``).  A block of anchors meets a
block of candidates as float32 matrices of balanced residues modulo several
small primes; every product stays below 2^24 and is exact, and the residues of
the scores are put together by Chinese remaindering in mixed radix.  As many
primes are taken as the largest components of the two blocks ask for, so the
scores are exact at any magnitude (they saturate beyond 64 bits).

Candidates are dealt over cells; every anchor travels to every cell, a row at
a time, behind the cell's candidates, and blocks are made where they meet: no
row or batch grows with the input.  First the anchors meet the candidates of
their own label, for their best positives; every cell answers with at most
``positives`` rows an anchor, and a window keeps the best.  Each positive gives
a range of scores; then the anchors meet the candidates of other labels, cells
answer with the first rows inside each range, and a window selects among them.
A hot label is in all cells.

Defined results: rows with a null id, a null label, a null vector or a null or
non-finite component take no part; vectors of different lengths are not
compared; rows that carry the anchor's id are neither its positives nor its
negatives; repeated rows are candidates each, and repeated anchor rows give
one answer; ties go to the smaller id; an anchor without positives, or a
positive without negatives in its range, gives no row; an empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Candidates and anchors of a block; components of a cell's candidates, at most
#: (about), candidates of a cell, at least, and cells for each core.
BLOCK = 1024
ANCHORS = 256
CELL, LEAST_CELL, CELLS_A_CORE = 1 << 22, 64, 4
#: Whole numbers below this are exact in float32.
EXACT = 1 << 24
#: Primes below SMALL are used first; the others serve extreme components.
SMALL, LARGE = 256, 2048
LONGEST = (1 << 63) - 1
#: Below any score.
NONE = -1 << 63


def primes() -> list[int]:
    sieve = [n for n in range(3, LARGE) if all(n % f for f in range(2, int(n**0.5) + 1))]
    return [p for p in reversed(sieve) if p < SMALL] + [p for p in sieve if p > SMALL]


PRIMES = primes()


def primes_for(bound: int) -> list[int]:
    """The largest primes below SMALL, then those up to LARGE, until their
    product is over four times ``bound``."""
    out, product = [], 1
    for p in PRIMES:
        if product > 4 * bound + 4:
            break
        out.append(p)
        product *= p
    return out


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of whole numbers around zero (at most one beyond p/2)."""
    return x - np.asarray(p, x.dtype) * np.rint(x / np.asarray(p, x.dtype))


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues, as float32, of whole float64 numbers of any size."""
    return balanced(np.fmod(x, p), p).astype(np.float32)


def product_residues(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``: float32 products over as many components at a
    time as stay exact."""
    step = max(1, EXACT // (p // 2 + 2) ** 2)
    total = None
    for at in range(0, max(1, a.shape[1]), step):
        part = balanced(a[:, at:at + step] @ b[:, at:at + step].T, p)
        total = part if total is None else balanced(total + part, p)
    return total


class Vectors:
    """Rows of whole components, with their residues once they are asked for."""

    def __init__(self, x: np.ndarray):
        self.x, self.most, self.of = x, int(np.abs(x).max()) if x.size else 0, {}

    def residues(self, p: int) -> np.ndarray:
        if p not in self.of:
            self.of[p] = residues(self.x, p)
        return self.of[p]


def scores(a: np.ndarray | Vectors, b: np.ndarray | Vectors) -> np.ndarray:
    """Exact integer products of the rows of ``a`` and ``b`` as int64."""
    a, b = (v if isinstance(v, Vectors) else Vectors(v) for v in (a, b))
    if not a.x.size or not b.x.size:
        return np.zeros((len(a.x), len(b.x)), dtype=np.int64)
    primes = primes_for(a.x.shape[1] * a.most * b.most)
    weights = [1]
    for p in primes:
        weights.append(weights[-1] * p)
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        # Mixed radix: take the lower digits off, divide by their primes.
        d = product_residues(a.residues(p), b.residues(p), p)
        for q, lower in zip(primes[:i], digits, strict=True):
            inverse = np.float32((pow(q, -1, p) + p // 2) % p - p // 2)
            d = balanced((d - lower) * inverse, p)  # exact: less than LARGE * LARGE / 2
        digits.append(d)
    if weights[-1] < 1 << 53:
        whole = digits.pop().astype(np.float32 if weights[-1] < EXACT else np.float64, copy=False)
        for p, d in zip(reversed(primes[:-1]), reversed(digits), strict=True):
            whole *= whole.dtype.type(p)
            whole += d
        return whole.astype(np.int64)
    if weights[-1] < 1 << 62:
        return sum((w * d.astype(np.int64) for w, d in zip(weights, digits, strict=False)), np.zeros(digits[0].shape, np.int64))
    big = sum((w * d.astype(np.int64).astype(object) for w, d in zip(weights, digits, strict=False)), np.zeros(digits[0].shape, object))
    return np.clip(big, -LONGEST, LONGEST).astype(np.int64)


def quantise(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), as whole numbers in float64 (beyond its range: its ends)."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(scale * x))


def whole_rows(vectors: DataFrame, label: Column, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, label, dim, x``: the rows that take part, with their whole
    components as float64 bytes."""
    named = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [c.values.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.column(2)]  # null -> nan
            good = [np.isfinite(c).all() for c in cells]
            x = [quantise(c, scale) for c, ok in zip(cells, good, strict=True) if ok]
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array([len(c) for c in x], pa.int32()), pa.array([c.tobytes() for c in x], pa.binary())],
                                             names=["vec_id", "label", "dim", "x"])

    return named.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").mapInArrow(run, "vec_id long, label string, dim int, x binary")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), dim)


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The sorted rows by runs of equal keys, a batch at a time: a long run comes in parts."""
    for batch in batches:
        change = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
        for k in range(n_keys):
            c = batch.column(k).to_numpy(zero_copy_only=False)
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield tuple(batch.column(k)[a].as_py() for k in range(n_keys)), batch.slice(a, b - a)


class Candidates:
    """A block of candidates of a cell, in the order of their labels."""

    def __init__(self, rows: pa.RecordBatch, dim: int):
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy(zero_copy_only=False)
        self.vectors = Vectors(matrix(rows["x"], dim))
        self.label = self.labels[0] if self.labels[0] == self.labels[-1] else None  # of all


def meetings(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[int, list[Candidates], pa.RecordBatch]]:
    """(length, blocks of candidates, up to ANCHORS anchors) from rows sorted by
    ``n_keys`` columns (the second is the length) and ``kind``: candidates (0)
    first, then the anchors (1) that meet them."""
    now, blocks = None, []
    for (*key, kind), rows in runs(batches, n_keys + 1):
        if key != now:
            now, blocks = key, []
        for at in range(0, rows.num_rows, size := ANCHORS if kind else BLOCK):
            part = rows.slice(at, size)
            if not kind:
                blocks.append(Candidates(part, key[1]))
            elif blocks:
                yield key[1], blocks, part


class Best:
    """The ``k`` best of the scores shown for each row that are at least ``low``
    and at most ``high``, ties to the smaller id."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray):
        self.k, self.low, self.high = k, low.copy(), high
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.full = False

    def show(self, rows: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        """Scores of ``rows`` (numbers of rows, rising) with the candidates ``ids``."""
        high = self.high[rows, None]
        if not self.full and found.shape[1] > self.k:
            # Only what is among the k best of this block can be so in all.
            at = found.shape[1] - self.k
            self.low[rows] = np.maximum(self.low[rows], np.partition(np.where(found <= high, found, NONE), at, axis=1)[:, at])
            self.full = len(rows) == len(self.low)
        fit = found >= self.low[rows, None]
        fit &= found <= high
        r, c = np.divmod(np.flatnonzero(fit), found.shape[1])
        if not len(r):
            return
        row, score, id_ = (np.concatenate(x) for x in ((self.row, rows[r]), (self.score, found[r, c]), (self.id, ids[c])))
        order = np.lexsort((id_, ~score, row))  # ~ turns the order, without overflow
        row, score, id_ = row[order], score[order], id_[order]
        first = np.searchsorted(row, row)
        place = np.arange(len(row)) - first
        last = place == self.k - 1
        self.low[row[last]] = np.maximum(self.low[row[last]], score[last])
        self.row, self.score, self.id = (x[place < self.k] for x in (row, score, id_))


def longs(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names.split())


def without_own(found: np.ndarray, own: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The scores, none where a candidate has the anchor's id."""
    if np.isin(own, ids).any():
        found[own[:, None] == ids] = NONE
    return found


def mine(vectors: DataFrame, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 3, scale: float = 256.0,
         least: int = 50, most: int = 95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every row with ``is_anchor`` (a condition on
    ``vec_id``) and each of its best other rows of the same ``label``, the
    first rows of another label with ``least`` to ``most`` percent of the
    positive's score."""
    spark = vectors.sparkSession
    rows = written(whole_rows(vectors, label, scale, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    n, components = rows.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    n_cells = max(1, components // CELL, min(n // LEAST_CELL, CELLS_A_CORE * spark.sparkContext.defaultParallelism))
    nothing = F.lit(None).cast("array<long>")
    candidates = rows.select(F.pmod(F.xxhash64("row"), F.lit(n_cells)).cast("int").alias("cell"), "dim", "label", F.lit(0).alias("kind"), F.col("row").alias("no"), "vec_id", "x", nothing.alias("places"), nothing.alias("tops"))
    anchors = written(rows.where(is_anchor).groupBy("vec_id", "dim", "label", "x").agg(F.min("row").alias("no")), "negatives-anchors")
    cells = F.explode(F.sequence(F.lit(0), F.lit(n_cells - 1))).alias("cell")

    def met(asking: DataFrame, order: list[str]) -> DataFrame:
        """All candidates and, in every cell, all of ``asking`` behind them."""
        all_rows = candidates.unionByName(asking.select(cells, "dim", "label", F.lit(1).alias("kind"), "no", "vec_id", "x", "places", "tops"))
        # By a hash of the cell: never dropped for what a plan below has dealt.
        return all_rows.select(*order, *[c for c in all_rows.columns if c not in order]).repartition(n_cells, F.xxhash64("cell")).sortWithinPartitions(*order)

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, blocks, asked in meetings(batches, 3):
            own, x = asked["vec_id"].to_numpy(), Vectors(matrix(asked["x"], dim))
            best = Best(positives, np.full(len(own), NONE + 1), np.full(len(own), LONGEST))
            for block in blocks:
                best.show(np.arange(len(own)), without_own(scores(x, block.vectors), own, block.ids), block.ids)
            yield longs("no anchor_id positive_id positive_score", asked["no"].to_numpy()[best.row], own[best.row], best.id, best.score)

    place = F.row_number().over(Window.partitionBy("no").orderBy(F.col("positive_score").desc(), "positive_id"))
    near = met(anchors.select("*", nothing.alias("places"), nothing.alias("tops")), ["cell", "dim", "label", "kind", "vec_id"])
    best = near.mapInArrow(closest, "no long, anchor_id long, positive_id long, positive_score long").withColumn("place", place).where(F.col("place") <= positives)
    best = written(best, "negatives-positives")

    wanted = best.groupBy("no").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("want"))  # at most ``positives`` each
    looking = written(anchors.join(wanted, "no").select("dim", "no", "vec_id", "label", "x", F.col("want.place").cast("array<long>").alias("places"), F.col("want.positive_score").alias("tops")), "negatives-looking")

    def ends(top: int) -> tuple[int, int]:
        """least/100 * top and most/100 * top, in whole numbers; nothing is in 1 to 0."""
        low, high = -(-least * top // 100), most * top // 100
        return (max(low, -LONGEST), min(high, LONGEST)) if low <= LONGEST and high >= -LONGEST else (1, 0)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, blocks, asked in meetings(batches, 2):
            own, labels, x = asked["vec_id"].to_numpy(), asked["label"].to_numpy(zero_copy_only=False), matrix(asked["x"], dim)
            all_x, no = Vectors(x), asked["no"].to_numpy()
            ranges = np.array([[ends(t) for t in tops] + [(1, 0)] * (positives - len(tops)) for tops in asked["tops"].to_pylist()], dtype=np.int64)
            places = np.array([p + [0] * (positives - len(p)) for p in asked["places"].to_pylist()], dtype=np.int64)
            best = [Best(negatives, ranges[:, k, 0], ranges[:, k, 1]) for k in range(positives)]
            for block in blocks:
                other = np.arange(len(own)) if block.label is None else np.flatnonzero(labels != block.label)
                if not len(other):
                    continue
                found = without_own(scores(all_x if len(other) == len(own) else x[other], block.vectors), own[other], block.ids)
                if block.label is None:
                    found[labels[:, None] == block.labels] = NONE
                for b in best:
                    b.show(other, found, block.ids)
            for k, b in enumerate(best):
                yield longs("no place negative_id negative_score", no[b.row], places[b.row, k], b.id, b.score)

    rank = F.row_number().over(Window.partitionBy("no", "place").orderBy(F.col("negative_score").desc(), "negative_id"))
    far = met(looking, ["cell", "dim", "kind", "label", "vec_id"])
    hard = far.mapInArrow(between, "no long, place long, negative_id long, negative_score long").withColumn("rank", rank).where(F.col("rank") <= negatives)
    return hard.join(best, ["no", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: DuckDB twin of the query: ids divisible by 50 are anchors, labels of ids
#: divisible by 7 move on by one.
MINE_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
         CAST(list_dot_product(a.e, x.e) AS BIGINT) AS score
  FROM v a JOIN v x ON len(a.e) = len(x.e) AND a.vec_id <> x.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""
