import datetime as dt
import json

import pytest
from conftest import meta, trade

from barforge.operators import checks
from barforge.operators.silver import silver_trades

AS_OF = "2024-01-01 12:00:00"
T_AS_OF = 1704110400000


def silver_at(spark, raw, offsets_ms):
    rows = [(meta(T_AS_OF + o), trade(t=i, T=T_AS_OF + o)) for i, o in enumerate(offsets_ms)]
    return silver_trades(raw(rows))


def first(df):
    return df.first().asDict()


def test_activity_window_is_inclusive_and_open_ended(spark, raw):
    s = silver_at(spark, raw, [-300000, -300001, 3600000])   # at the bound, just before, future
    r = first(checks.check_recent_activity(s, AS_OF, min_rows=2))
    assert (r["observed"], r["passed"]) == (2.0, True)
    r = first(checks.check_recent_activity(s, AS_OF, min_rows=3))
    assert r["passed"] is False


def test_silver_lag_threshold(spark, raw):
    s = silver_at(spark, raw, [-600000])
    assert first(checks.check_silver_lag(s, AS_OF))["passed"] is True
    s = silver_at(spark, raw, [-601000])
    r = first(checks.check_silver_lag(s, AS_OF))
    assert (r["observed"], r["passed"]) == (601.0, False)


def test_empty_tables_fail_freshness(spark, raw):
    empty = silver_at(spark, raw, [0]).limit(0)
    r = first(checks.check_silver_lag(empty, AS_OF))
    assert r["observed"] is None and r["passed"] is False
    bronze = raw([(meta(T_AS_OF), trade())]).limit(0)
    r = first(checks.check_bronze_recent(bronze, AS_OF))
    assert (r["observed"], r["passed"]) == (0.0, False)


def test_bronze_recency_uses_a_safe_parse_and_clamps_the_window(spark, raw):
    rows = [(meta(T_AS_OF), trade(t=1, T=T_AS_OF - 30000)), (meta(T_AS_OF), trade(t=2, T="bad"))]
    r = first(checks.check_bronze_recent(raw(rows), AS_OF, window_minutes=0))
    assert r["observed"] == 1.0 and "rows in last 1 min: 1" in r["detail"]


def test_duplicates_and_nulls(spark, raw):
    from barforge.operators.silver import parse_trades, valid_trades
    rows = [(meta(T_AS_OF + i), trade(t=1)) for i in range(3)] + [(meta(T_AS_OF), trade(t=2, p="x"))]
    parsed = parse_trades(raw(rows))
    assert first(checks.check_no_duplicates(valid_trades(parsed)))["observed"] == 1.0
    assert first(checks.check_not_nulls(parsed))["observed"] == 1.0
    assert first(checks.check_no_duplicates(silver_trades(raw(rows))))["passed"] is True


def metering(spark, rows):
    return spark.createDataFrame(
        [(w, dt.datetime.fromisoformat(t), c) for w, t, c in rows],
        "warehouse_name string, start_time timestamp_ntz, credits_used decimal(20,6)")


@pytest.mark.parametrize("credits,passed", [("100.0", True), ("100.01", False)])
def test_credit_guardrail(spark, credits, passed):
    from decimal import Decimal
    m = metering(spark, [("WH", "2024-01-01 03:00:00", Decimal(credits)),
                         ("WH", "2023-12-31 23:00:00", Decimal("50")),
                         ("OTHER", "2024-01-01 03:00:00", Decimal("500"))])
    assert first(checks.check_daily_credits(m, AS_OF, "WH"))["passed"] is passed


def test_credit_guardrail_without_rows(spark):
    r = first(checks.check_daily_credits(metering(spark, []), AS_OF, "WH"))
    assert (r["observed"], r["passed"]) == (0.0, True)


def status(spark, docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)],
                                 "doc_id long, status_json string")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_pipeline_status_rules_in_order(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        _status_rules(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def _status_rules(spark):
    docs = [
        {"connector": {"state": "RUNNING"}, "tasks": [{"state": "RUNNING"}]},
        {"connector": {"state": "FAILED"}, "tasks": []},
        {"connector": {"state": "RUNNING"}},
        {"connector": {"state": "RUNNING"}, "tasks": []},
        {"connector": {"state": "RUNNING"}, "tasks": [{"state": "RUNNING"}, {"state": "PAUSED"}]},
        {},
    ]
    got = {r.doc_id: (r.passed, r.detail) for r in checks.check_pipeline_status(status(spark, docs)).collect()}
    assert got[0] == (True, "pipeline and tasks up")
    assert got[1] == (False, "pipeline reports FAILED")
    assert got[2] == (False, "pipeline lists no task")
    assert got[3] == (False, "pipeline lists no task")
    assert got[4] == (False, "a task reports PAUSED")
    assert got[5] == (False, "pipeline reports no state")


def test_suite_stops_at_first_failure_and_enforce_raises(spark, raw):
    s = silver_at(spark, raw, [-1000])
    suite = checks.quality_suite(s, AS_OF, min_rows=1)
    assert all(r.passed and not r.skipped for r in suite.collect())
    checks.enforce(suite)
    st = status(spark, [{"connector": {"state": "FAILED"}}])
    bronze = raw([(meta(T_AS_OF), trade(T=T_AS_OF - 1000))])
    health = checks.health_suite(st, bronze, s, AS_OF).orderBy("ord").collect()
    assert [(r.passed, r.skipped) for r in health] == [(False, False), (True, True), (True, True)]
    fails = checks.failures(checks.health_suite(st, bronze, s, AS_OF), "run-1").collect()
    assert [(f.task, f.run_id) for f in fails] == [("connector_status", "run-1")]
    with pytest.raises(RuntimeError, match="pipeline reports FAILED"):
        checks.enforce(checks.health_suite(st, bronze, s, AS_OF))


def test_daily_summary_and_layer_lag(spark, raw):
    from barforge.operators.gold import gold_trades_1m
    rows = [(meta(T_AS_OF - 1000), trade(t=1, T=T_AS_OF - 2000)),
            (meta(T_AS_OF - 1000), trade(t=2, T=T_AS_OF - 86400001))]
    b = raw(rows)
    s = silver_trades(b)
    g = gold_trades_1m(s)
    r = first(checks.daily_summary(b, s, g, AS_OF))
    assert (r["bronze_rows"], r["silver_rows"], r["gold_buckets"]) == (1, 1, 1)
    lag = first(checks.layer_lag(b, s, g, AS_OF))
    assert (lag["bronze_lag_seconds"], lag["silver_lag_seconds"], lag["gold_lag_seconds"]) == (2, 1, 60)


def test_time_bound_reaches_the_raw_scan_and_drops_nothing(spark, raw):
    import re

    from pyspark.sql import functions as F

    from barforge.session import fresh_dir
    from barforge.sources.fixtures import with_trade_time
    from barforge.sources.topic import LANDING_PARTS, read_bronze
    path = fresh_dir(spark, "ingest") + "/bronze"
    today = raw([(meta(T_AS_OF), trade(t=1, T=T_AS_OF - 1000)), (meta(T_AS_OF), trade(t=3, T="bad"))])
    long_ago = raw([(meta(T_AS_OF), trade(t=2, T=T_AS_OF + 3600000))])   # future-dated, ingested earlier
    for df, day in ((today, "2024-01-01"), (long_ago, "2023-12-01")):
        with_trade_time(df).withColumn("lane", F.lit("raw")).withColumn("ingest_date", F.lit(day).cast("date")) \
            .write.mode("append").partitionBy(*LANDING_PARTS).parquet(path)
    b = read_bronze(spark, path)
    recent = checks.check_bronze_recent(b, AS_OF)
    assert first(recent)["observed"] == 2.0
    p = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*trade_time", p)
    assert re.search(r"ReadSchema: struct<trade_time:timestamp_ntz>", p)


def test_count_where_and_failure_records(spark, raw):
    import os

    from pyspark.sql import functions as F

    from barforge.session import fresh_dir
    s = silver_at(spark, raw, [-1000, -2000, 5000])
    assert first(checks.count_where(s, F.col("trade_time") > F.lit(AS_OF).cast("timestamp_ntz")))["n"] == 1
    st = status(spark, [{"connector": {"state": "FAILED"}}])
    fails = checks.failures(checks.health_suite(st, raw([(meta(T_AS_OF), trade())]), s, AS_OF), "r1", "logs/")
    path = os.path.join(fresh_dir(spark, "alerts"), "alerts")
    checks.record_failures(fails, path)
    checks.record_failures(fails, path)
    assert {r.log_link for r in fails.collect()} == {"logs/healthcheck/connector_status/r1"}
    assert spark.read.parquet(path).count() == 2


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_duplicates_are_counted_by_bitmaps(spark):
    """No key is exchanged where no block has repeats; blocks that have some,
    or hold null numbers, are grouped exactly."""
    ids = spark.range(-70_000, 70_000).selectExpr("if(id % 3 = 0, 'A', 'B') as symbol", "id as trade_id")
    clean = checks.check_no_duplicates(ids)
    plan = final_plan(clean)
    assert first(clean)["observed"] == 0.0
    assert "bitmap_construct_agg" in clean._jdf.queryExecution().toString()
    assert "EmptyRelation" in plan and "hashpartitioning(symbol" not in plan.replace("_block", "")
    some = ids.unionByName(ids.filter("trade_id between -2 and 40000 and trade_id % 1000 < 2")).unionByName(ids.filter("trade_id = 5"))
    extra = spark.sql("select * from values (cast(null as string), 1L), (null, 1L), ('C', cast(null as bigint)), ('D', null), ('D', null) t(symbol, trade_id)")
    for df in (some, extra, some.unionByName(extra), ids.limit(0)):
        want = df.groupBy("symbol", "trade_id").count().filter("count > 1").count()
        assert first(checks.check_no_duplicates(df))["observed"] == float(want)


def test_checks_after_a_failure_do_no_work(spark, raw):
    from barforge.session import written_table
    s = written_table(silver_at(spark, raw, [-1000, -2000]), "short-circuit")
    made = checks.quality_until_failure(s, AS_OF, min_rows=1)
    assert [(r.passed, r.skipped) for r in made.orderBy("ord").collect()] == [(True, False)] * 3
    twice = written_table(s.unionByName(s), "short-circuit")
    made = checks.quality_until_failure(twice, AS_OF, min_rows=1)
    rows = sorted(made.collect(), key=lambda r: r.ord)
    assert [(r.passed, r.skipped, r.detail == "not run") for r in rows] == [(True, False, False), (False, False, False), (None, True, True)]
    # The activity check's scan (of one column) is gone from the plan that ran.
    assert "ReadSchema: struct<trade_time:timestamp_ntz>" not in final_plan(made)
    with pytest.raises(RuntimeError, match="silver_no_duplicates"):
        checks.enforce(made)
    assert [f.task for f in checks.failures(made, "r").collect()] == ["silver_no_duplicates"]
    st = status(spark, [{"connector": {"state": "FAILED"}}])
    health = checks.health_until_failure(st, raw([(meta(T_AS_OF), trade(T=T_AS_OF - 1000))]), s, AS_OF)
    assert [(r.passed, r.skipped) for r in health.orderBy("ord").collect()] == [(False, False), (None, True), (None, True)]
