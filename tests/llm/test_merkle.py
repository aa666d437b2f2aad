"""The Merkle manifest against a plain tree in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from barforge.llm import merkle_manifest, queries

from llm_fixtures import documents, empty, ugly  # noqa: F401


def digest(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, text=...):
    row = dict(row) if text is ... else row | {"text": text}
    return digest("".join(field(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def tree(hashes):
    """Root, and for every leaf what stands before and after it by level."""
    at, paths, level = list(range(len(hashes))), [[] for _ in hashes], hashes
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 3 * 3:][:3]
            paths[i].append(("".join(run[:place % 3]), "".join(run[place % 3 + 1:])))
            at[i] = place // 3
        level = [digest("".join(level[a:a + 3])) for a in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        mine = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append((mine, *tree([leaf_of(r) for r in mine])))
    root, tops = tree([t[1] for t in trees])
    out = []
    for (mine, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(mine, paths, strict=True):
            text, now = r["text"], leaf_of(r)
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                now = leaf_of(r, text.replace("\n", ""))
            for before, after in path + top:
                now = digest(before + now + after)
            out.append((r["doc_id"], leaf_of(r), subroot, root, digest("".join(a + b for a, b in path + top)), now, now == root))
    return out


def answer(spark, df, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle_manifest.manifest, "__defaults__", (None, levels))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_merkle_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_manifest_equals_brute_force(spark, tmp_path, monkeypatch, levels):
    """A hot source of 28 leaves (just over a power of three), runs of one,
    lone leaves, and texts with line feeds."""
    n = 40
    texts = [f"line {i}\nmore\n" if i % 3 else f"plain {i}" for i in range(n)]
    sources = ["hot"] * 28 + [f"s{i}" for i in range(4)] + ["Zed"] * 3 + [None] * 4 + [""]
    df = documents(spark, texts, ["en", None] * 20, sources)
    assert answer(spark, df, tmp_path, monkeypatch, levels) == sorted(brute([r.asDict() for r in df.collect()]), key=repr)


def test_manifest_of_odd_rows(spark, ugly, tmp_path, monkeypatch):  # noqa: F811
    """Nulls in any column, repeated rows, one very long text."""
    df = ugly.unionByName(ugly.limit(6))
    assert answer(spark, df, tmp_path, monkeypatch, 2) == sorted(brute([r.asDict() for r in df.collect()]), key=repr)


def test_manifest_of_nothing(spark, empty, tmp_path, monkeypatch):  # noqa: F811
    assert answer(spark, empty, tmp_path, monkeypatch, 2) == []


def test_one_exchange_serves_all_levels(spark):
    nodes = spark.range(1000).select((F.col("id") % 2).alias("tree"), F.col("id").alias("rank"), F.lit("h").alias("hash"), F.col("id").alias("payload"))
    plan = merkle_manifest.rolled_up(nodes, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
