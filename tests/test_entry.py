"""Driver contract: entry smoke check and the oracle gate on the fast plans."""

import os
import sys

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_entry_runs_on_smallest_scale(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 843
    assert df.columns[:2] == ["symbol", "minute_bucket"]


def test_every_query_has_an_oracle(spark):
    import __spark_entry__ as E
    from barforge.plans.catalog import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_batch_plans_match_oracle(spark):
    from oracle_compare import compare
    from test_plans import STREAMING

    from barforge.plans.catalog import QUERIES
    names = sorted(set(QUERIES) - STREAMING)
    res = compare(spark, SF_SMALL, names, verbose=True)
    assert {k: v for k, v in res.items() if v != "match"} == {}


def test_results_do_not_depend_on_the_session_zone(spark):
    """Run the time-sensitive plans in a DST zone; they must still match."""
    from oracle_compare import compare
    names = ["silver_trades", "gold_trades_1m", "recent_activity", "bronze_recency",
             "silver_lag", "layer_lag", "daily_summary", "daily_credits", "admit_trades"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        res = compare(spark, SF_SMALL, names, verbose=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert {k: v for k, v in res.items() if v != "match"} == {}


def test_shared_folder_comes_from_the_session(spark):
    """With and without a scheme, through the file system Spark itself uses."""
    from types import SimpleNamespace

    from barforge.session import fresh_dir, shared_dir, written_table
    base = fresh_dir(spark, "root").removeprefix("file://")
    for root in (base, "file://" + base):
        named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None, root=root: root),
                                sparkContext=spark.sparkContext)
        assert shared_dir(named, "a", "b") == f"{root}/a/b"
        path = fresh_dir(named, "a")
        assert path.startswith(root + "/runs/a-") and path != fresh_dir(named, "a")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert written_table(spark.range(3), "t").count() == 3
