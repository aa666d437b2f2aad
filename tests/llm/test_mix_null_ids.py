"""Mixing documents without ids: targets are met, and equal to the SQL twin."""

import duckdb
from llm_fixtures import documents, prose

from barforge.llm import mix_sources


def test_null_ids_meet_their_targets(spark, tmp_path):
    n = 400
    texts = [prose(i, 5 + i % 7) for i in range(n)]
    for ids in ([None] * n, [None if i % 2 else i for i in range(n)]):
        df = documents(spark, texts, sources=["a" if i % 2 else "b" for i in range(n)])
        df = spark.createDataFrame([(i, *r[1:]) for i, r in zip(ids, df.collect(), strict=True)], df.schema)
        path = str(tmp_path / f"d{ids.count(None)}.parquet")
        df.write.parquet(path)
        got = mix_sources.mix_sources(spark.read.parquet(path), [1, 2, 3]).select("doc_id", "size", "source_size", "target", "taken").collect()
        taken = {}
        for r in got:
            taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
        assert all(abs(words - target) <= 12 for (_, target), words in taken.items())
        con = duckdb.connect()
        con.execute(f"create view documents as select * from '{path}/*.parquet'")
        want = con.execute(f"select doc_id, size, source_size, target, taken from ({mix_sources.mix_sql()}) m").fetchall()
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[4])
        for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
            assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-6 and g[4] == w[4]
