"""Embedding near-dedup and exact top-k against brute force."""

import numpy as np
from pyspark.sql import functions as F

from barforge.llm import itq_dedup, norm_topk

SCHEMA = "vec_id long, embedding array<float>, label int, norm double, code long, copies long, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 2, 3, 4) for i, v in rows], SCHEMA)


def clouds(seed, n=300, dim=16, near=0.08):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = centres[rng.integers(0, 12, n)] * 1.0
    x = np.where(rng.random((n, 1)) < 0.5, x + near * rng.standard_normal((n, dim)), rng.standard_normal((n, dim)))
    x[: n // 3] = x[0] + 0.02 * rng.standard_normal((n // 3, dim))  # one large group of near copies
    x[-20:] = x[-1]  # exact copies
    return (x * rng.uniform(0.5, 3, (n, 1))).astype(np.float32).astype(float)


def brute_links(ids, x, least=0.9):
    n = np.linalg.norm(x, axis=1)
    near = (x @ x.T) / np.outer(n, n) >= least - 1e-12
    root = np.array(ids)
    while True:
        new = np.array([root[near[i]].min() for i in range(len(ids))])
        if (new == root).all():
            break
        root = new
    return near, root


ODD = [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] + [1.0] * 15), (9004, [None] + [1.0] * 15), (9005, []), (9006, [-0.0] * 16),
       (9007, [1.0, 2.0]), (9008, [2.0, 4.0]), (9009, [float("inf")] * 16)]


def test_itq_finds_the_links(spark, monkeypatch):
    x = clouds(1)
    ids = list(range(1, len(x) + 1))
    near, _ = brute_links(ids, x)
    want = near.sum() - len(ids)
    for block in (512, 16):  # 16: buckets dealt in chunk pairs
        monkeypatch.setattr(itq_dedup, "BLOCK", block)
        rows = {r.vec_id: r for r in itq_dedup.near_duplicates(frame(spark, [*zip(ids, x.tolist(), strict=True), *ODD])).collect()}
        assert len(rows) == len(ids) + len(ODD)
        got = np.array([rows[i].n_links for i in ids])
        assert (got <= near.sum(axis=1) - 1).all()  # no link below the threshold, none counted twice
        assert got.sum() >= 0.95 * want
        assert len({rows[i].component_id for i in ids[: len(ids) // 3]}) == 1
        assert all(r.kept == (r.vec_id == r.component_id) for r in rows.values())
        for i, _ in ODD:
            assert (rows[i].n_links, rows[i].component_id) == ((1, 9007) if i in (9007, 9008) else (0, i))


def test_every_near_pair_counts_in_one_bucket():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 62, 2000)
    b = a.copy()
    for _ in range(9):
        b ^= np.int64(1) << rng.integers(0, 63, 2000)
    bucket = itq_dedup.meeting_bucket(a, b)
    assert (bucket == itq_dedup.meeting_bucket(b, a)).all() and (bucket >= 0).all()
    band, value = bucket >> itq_dedup.WIDTH, bucket & (1 << itq_dedup.WIDTH) - 1
    for x in (a, b):  # both are filed there: at most one bit away
        own = x >> (band * itq_dedup.WIDTH) & (1 << itq_dedup.WIDTH) - 1
        assert (np.bitwise_count(own ^ value) <= 1).all()


def test_itq_on_nothing(spark):
    assert itq_dedup.near_duplicates(frame(spark, [])).collect() == []
    assert [tuple(r)[:3] for r in itq_dedup.near_duplicates(frame(spark, [(5, [1.0] * 4), (5, [1.0] * 4)])).collect()] == [(5, 1, 5)] * 2


def test_extreme_lengths(spark):
    """Cosine and products of vectors whose squares overflow or vanish."""
    rows = [(1, [1e-200, 1e-200]), (2, [1e-200, 1e-203]), (3, [1e200, 1e200]), (4, [1e200, 1.1e200]), (5, [5e-324, 0.0]), (6, [1e308, 1e300]),
            (50, [1e200, -1e200]), (100, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq_dedup.near_duplicates(df).collect()}
    # {1, 3, 4, 100} and {2, 5, 6} point the same way
    assert got == {1: (3, 1), 3: (3, 1), 4: (3, 1), 100: (3, 1), 2: (2, 2), 5: (2, 2), 6: (2, 2), 50: (0, 50)}
    top = [1 << 63, -(1 << 63)]
    found = {}
    for r in norm_topk.top_k(df, F.col("vec_id") % 50 == 0, scale=1.0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(found[100]) == [(1, 3, top[0] - 1), (2, 4, top[0] - 1), (3, 6, top[0] - 1), (4, 1, 0), (5, 2, 0)]
    assert sorted(found[50])[0] == (1, 6, top[0] - 1) and len(found[50]) == 5


def test_components_equal_brute_force(spark):
    """Well separated groups: links, components and kept rows exactly."""
    rng = np.random.default_rng(11)
    centres = np.eye(16)[rng.integers(0, 16, 200)]
    x = (centres + 0.01 * rng.standard_normal((200, 16))) * rng.uniform(0.1, 9, (200, 1))
    x = x.astype(np.float32).astype(float)
    ids = list(range(1, 201))
    near, root = brute_links(ids, x)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in itq_dedup.near_duplicates(frame(spark, list(zip(ids, x.tolist(), strict=True)))).collect()}
    assert got == {i: (int(near[i - 1].sum()) - 1, int(root[i - 1]), bool(root[i - 1] == i)) for i in ids}


def brute_top(rows, k=5):
    out = []
    whole = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    for q, a in {(i, tuple(v)) for i, v in whole if i % 50 == 0}:
        best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if len(a) == len(b) and i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(norm_topk, "BUCKET", 64)
    monkeypatch.setattr(norm_topk, "QUERY_BLOCK", 3)
    x = clouds(3, 400)
    rows = [*zip(range(1, 401), x.tolist(), strict=True), *ODD, (9050, [1.0, 2.0]), (9100, [0.0] * 16), (9150, None), (9200, [7.0])]
    got = norm_topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)
    assert norm_topk.top_k(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_long_vectors_prune_by_coordinate_and_stay_exact():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.standard_normal((500, 8)) * rng.uniform(0.1, 8, (500, 1)))
    x = x[np.argsort(-np.linalg.norm(x, axis=1), kind="stable")]
    q = np.floor(256 * rng.standard_normal((40, 8)))
    ids = np.arange(500)
    exact = (q @ x.T).astype(np.int64)
    floor = np.sort(exact, axis=1)[:, -5].astype(float)
    seen = set()
    for place, found, scores in norm_topk.search_block(q, np.arange(40) + 1000, floor, x, ids, 5):
        best = norm_topk.top_of(scores, found, 5)
        want = norm_topk.top_of(exact[place], ids, 5)
        assert found[best].tolist() == want.tolist() and scores[best].tolist() == exact[place][want].tolist()
        seen.add(place)
    assert seen == set(range(40))


def test_products_stay_exact_beyond_double():
    a = np.array([[2.0**40, 3.0], [-(2.0**60), 0.0]])
    assert norm_topk.products(a, a).tolist() == [[(1 << 63) - 1, -(1 << 63)], [-(1 << 63), (1 << 63) - 1]]
    assert norm_topk.products(a[:1] / 2**12, a[:1] / 2**12 + 1).tolist() == [[2**28 * (2**28 + 1)]]
