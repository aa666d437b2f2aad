"""Vectors as packed bytes, and groups of sorted Arrow rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unit_range(x: np.ndarray) -> np.ndarray:
    """``x`` times the power of two that brings its largest component between
    a half and one: the same direction, and squares that neither overflow nor
    vanish.  Zero and empty vectors stay."""
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) if x.size else x


def packed(vectors: DataFrame, id_col: str, vec_col: str, to_unit_range: bool = False) -> DataFrame:
    """``vec_id, dim, vec, ok``: the vector's components as float64 bytes, on
    request brought to :func:`unit_range`; ``ok`` is false where the vector is
    null or holds a null or non-finite component (``vec`` is then null)."""
    narrow = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cell in batch.column(1):
                x = cell.values.to_numpy(zero_copy_only=False).astype(np.float64) if cell.is_valid else None  # null -> nan
                ok = x is not None and np.isfinite(x).all()
                out.append((unit_range(x) if to_unit_range else x).tobytes() if ok else None)
            dims = [None if b is None else len(b) // 8 for b in out]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(out, pa.binary()), pa.array([b is not None for b in out], pa.bool_())],
                                             names=["vec_id", "dim", "vec", "ok"])

    return narrow.mapInArrow(run, "vec_id long, dim int, vec binary, ok boolean")


def matrix(column: pa.Array, dim: int, dtype: str = "<f8") -> np.ndarray:
    """Rows of equally long packed vectors."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, dim)


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """One batch per run of equal values in the first ``n_keys`` columns."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and any(rest[-1].column(k)[-1] != batch.column(k)[0] for k in range(n_keys)):
            yield joined(rest)
            rest = []
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in range(n_keys):
            c = batch.column(k).to_numpy(zero_copy_only=False)
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rest.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield joined(rest)
                rest = []
    if rest:
        yield joined(rest)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def hash_share(col: str, share: float):
    """Filter that draws about ``share`` of the rows by a hash of ``col``."""
    return F.pmod(F.xxhash64(col), F.lit(1 << 20)) < min(1.0, share) * (1 << 20)
