import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barforge.session import build_session
    s = build_session("local[*]", app="barforge-tests", shuffle_partitions=8)
    yield s
    s.stop()


def make_raw(spark, rows):
    """A raw-layer frame from (metadata_json, content_json) text pairs."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "metadata string, content string")
    return df.select(F.parse_json("metadata").alias("record_metadata"),
                     F.parse_json("content").alias("record_content"))


@pytest.fixture
def raw(spark):
    return lambda rows: make_raw(spark, rows)


def trade(t=1, s="BTCUSDT", p="1.5", q="2.0", T=1704067200000, E=None, **extra):
    """JSON text of a trade payload (None values are left out)."""
    import json
    d = {"e": "trade", "E": E if E is not None else (T + 5 if isinstance(T, int) else 1704067200005), "s": s, "t": t, "p": p, "q": q,
         "b": 10, "a": 20, "T": T, "m": True}
    d.update(extra)
    return json.dumps({k: v for k, v in d.items() if v is not None})


def meta(ms=None, key="CreateTime"):
    import json
    return json.dumps({key: ms} if ms is not None else {})
