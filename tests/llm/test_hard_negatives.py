"""Hard negatives and their exact scores against plain Python."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barforge.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, x binary, row long, no long, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lb, 3, b"x", 1, 2, 4) for i, v, lb in rows], SCHEMA)


def dot(a, b):
    return max(-hard_negatives.LONGEST, min(hard_negatives.LONGEST, sum(int(p) * int(q) for p, q in zip(a, b, strict=True))))


def brute(rows):
    whole = []
    for i, v, lb in rows:
        if i is None or lb is None or v is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        whole.append((i, [int(np.floor(256 * float(np.float32(c)))) for c in v], (lb + 1) % 10 if i % 7 == 0 else lb))
    out = []
    for a, va, la in {(i, tuple(v), lb) for i, v, lb in whole if i % 50 == 0}:
        other = [(dot(va, v), i, lb) for i, v, lb in whole if len(v) == len(va) and i != a]
        for ps, p in sorted(((s, i) for s, i, lb in other if lb == la), key=lambda t: (-t[0], t[1]))[:5]:
            fit = sorted(((s, i) for s, i, lb in other if lb != la and 50 * ps <= 100 * s <= 95 * ps), key=lambda t: (-t[0], t[1]))[:3]
            out += [(a, p, r + 1, n, ps, s) for r, (s, n) in enumerate(fit)]
    return sorted(out)


def answer(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op12_hard_negatives(spark, str(tmp_path))
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    return sorted(map(tuple, got.collect()))


def cloud(n, seed, dim=12, scale=1.0):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((4, dim))[rng.integers(0, 4, n)] + 0.6 * rng.standard_normal((n, dim))) * scale
    labels = np.where(rng.random(n) < 0.4, 3, rng.integers(0, 10, n))  # a hot label
    return [(i, v, int(lb)) for i, v, lb in zip(range(1, n + 1), x.astype(np.float32).tolist(), labels, strict=True)]


ODD = [(None, [1.0] * 12, 1), (2000, None, 1), (2050, [None] + [1.0] * 11, 1), (2100, [float("nan")] * 12, 1), (2150, [1.0] * 12, None),
       (2200, [float("inf")] + [1.0] * 11, 2), (2250, [], 2), (2300, [1.0, 2.0], 2), (2301, [2.0, 2.0], 2), (2303, [1.0, 1.5], 4), (2350, [0.0] * 12, 3)]


def test_mining_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 32)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rows = [*cloud(400, 1), *ODD]
    rows += [(401 + i, rows[99][1], 3) for i in range(40)]  # ties with an anchor's copies
    got = answer(spark, rows, tmp_path)
    assert got == brute(rows) and len(got) > 50


def test_repeated_rows_are_candidates_each(spark, tmp_path):
    rows = cloud(120, 2)
    rows += [rows[49], rows[50], rows[51], rows[51]]  # an anchor twice, candidates again
    assert answer(spark, rows, tmp_path) == brute(rows)


def test_scores_beyond_64_bits_saturate(spark, tmp_path):
    rows = [(i, [c * 1e30 for c in v], lb) for i, v, lb in cloud(60, 3)] + [(i + 100, v, lb) for i, v, lb in cloud(60, 4)]
    assert answer(spark, rows, tmp_path) == brute(rows)


def test_nothing_to_mine(spark, tmp_path):
    assert answer(spark, [], tmp_path) == []


def test_one_label_has_no_negatives(spark):
    out = hard_negatives.mine(frame(spark, [(i, [1.0, float(i)], 1) for i in range(1, 101)]), F.col("label"), F.col("vec_id") % 50 == 0)
    assert out.collect() == []


@pytest.mark.parametrize("size", [1.0, 1e3, 1e6, 1e9, 1e15, 1e30, 1e200, 1e305])
def test_residue_scores_are_exact(size):
    rng = np.random.default_rng(5)
    a, b = (np.floor(rng.standard_normal((n, 1500 if size < 10 else 40)) * 256 * size) for n in (3, 5))
    assert hard_negatives.scores(a, b).tolist() == [[dot(p, q) for q in b] for p in a]


def test_residue_scores_at_the_ends():
    edge = np.array([[255.0, 255.0], [-256.0, -256.0], [0.0, 0.0]])
    assert hard_negatives.scores(edge, edge).tolist() == [[dot(p, q) for q in edge] for p in edge]
    assert hard_negatives.scores(np.zeros((2, 0)), np.zeros((1, 0))).tolist() == [[0], [0]]


def test_residue_products_stay_below_the_exact_bound():
    for p in hard_negatives.primes_for(10**600):
        step = max(1, hard_negatives.EXACT // (p // 2 + 2) ** 2)
        assert step * (p // 2 + 1) ** 2 <= hard_negatives.EXACT


def rows_of(keys, kind, ids, dim=2):
    n = len(ids)
    return pa.RecordBatch.from_arrays([pa.array([keys[0]] * n, pa.int32()), pa.array([keys[1]] * n, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(["a"] * n),
                                       pa.array(ids, pa.int64()), pa.array([np.ones(dim).tobytes()] * n, pa.binary())], names=["cell", "dim", "kind", "label", "vec_id", "x"])


def test_anchors_and_candidates_meet_in_bounded_blocks(monkeypatch):
    """Whatever comes to a cell, rows hold one vector each and blocks are made
    where they meet; candidates without anchors, and the reverse, meet nothing."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 4)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    batches = [rows_of((0, 2), 0, range(7)), rows_of((0, 2), 0, range(7, 9)), rows_of((0, 2), 1, range(5)), rows_of((0, 2), 1, [5]),
               rows_of((0, 3), 1, [1], 3), rows_of((1, 2), 0, [1]), rows_of((2, 2), 0, [2, 3]), rows_of((2, 2), 1, [9])]
    met = [(dim, [b.ids.tolist() for b in blocks], rows["vec_id"].to_pylist()) for dim, blocks, rows in hard_negatives.meetings(iter(batches), 2)]
    first = [[0, 1, 2, 3], [4, 5, 6], [7, 8]]
    assert met == [(2, first, [0, 1, 2]), (2, first, [3, 4]), (2, first, [5]), (2, [[2, 3]], [9])]


def test_what_spark_hands_on_is_one_vector_a_row(spark, tmp_path, monkeypatch):
    """Batches count rows, so a row must not hold blocks of vectors."""
    rows = cloud(600, 8)
    seen = []
    monkeypatch.setattr(hard_negatives, "written", lambda df, name, was=hard_negatives.written: (seen.append((name, dict(df.dtypes))), was(df, name))[1])
    assert answer(spark, rows, tmp_path) == brute(rows)
    assert [name for name, _ in seen] and all(kinds.get("x", "binary") == "binary" for _, kinds in seen)


def test_best_keeps_the_first_rows_of_a_range():
    rng = np.random.default_rng(6)
    for k in (1, 3, 7):
        low, high = rng.integers(-40, 5, 20), rng.integers(-5, 40, 20)
        best, shown = hard_negatives.Best(k, low, high), [[] for _ in range(20)]
        for width in (2, 30, 5, 64):
            rows = np.flatnonzero(rng.random(20) < 0.7)
            found, ids = rng.integers(-50, 50, (len(rows), width)), rng.integers(0, 30, width)
            best.show(rows, found, ids)
            for r, line in zip(rows.tolist(), found.tolist(), strict=True):
                shown[r] += [(-x, int(i)) for x, i in zip(line, ids, strict=True) if low[r] <= x <= high[r]]
        got = [[] for _ in range(20)]
        for r, x, i in zip(best.row.tolist(), best.score.tolist(), best.id.tolist(), strict=True):
            got[r].append((-x, i))
        assert got == [sorted(line)[:k] for line in shown]
