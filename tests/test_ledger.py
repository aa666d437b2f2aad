"""The maintenance ledger equals scans of the layers, under replays, stale
copies, batches without valid rows, and a rebuild."""

from conftest import make_raw, meta, trade
from pyspark.sql import functions as F
from test_incremental import apply_parts, events, new_layout

from barforge.functions.timefn import minute_bucket
from barforge.operators import checks
from barforge.sources import fixtures
from barforge.streaming import maintain as mt
from barforge.streaming import storage as stg

AS_OF = "2024-01-01 12:00:00"


def minutes_of(df):
    return sorted(map(tuple, df.select(minute_bucket(F.col("trade_time")).alias("m")).groupBy("m").count().collect()))


def same_as_scans(spark, layout, bronze):
    ledger, silver, gold = stg.read_ledger(spark, layout), stg.read_silver(spark, layout), stg.read_gold(spark, layout)
    assert sorted(map(tuple, checks.ledger_minutes(ledger).collect())) == minutes_of(silver)
    assert checks.ledger_layer_lag(ledger, AS_OF).first() == checks.layer_lag(bronze, silver, gold, AS_OF).first()
    assert checks.ledger_silver_lag(ledger, AS_OF).first() == checks.check_silver_lag(silver, AS_OF).first()
    for at in (AS_OF, "2024-01-01 11:59:30.5", "2023-12-31 00:00:00"):  # also inside a minute
        assert checks.ledger_recent_activity(ledger, silver, at).first() == checks.check_recent_activity(silver, at).first()


def test_ledger_equals_scans_and_replays_count_once(spark):
    tagged = fixtures.bronze_parts(events(spark), "redelivered_first")
    layout = new_layout(spark)
    apply_parts(spark, tagged, [0, 1, 2], layout)
    same_as_scans(spark, layout, tagged)
    apply_parts(spark, tagged, [0, 1, 2], layout)  # the same batches again
    same_as_scans(spark, layout, tagged)
    assert stg.read_ledger(spark, layout).agg(F.sum("raw_rows")).first()[0] == tagged.count()
    mt.rebuild(tagged.drop("part"), layout)
    same_as_scans(spark, layout, tagged)


def test_trades_that_move_leave_no_minute_behind(spark):
    """A later copy carries another trade time: the minute it left, which was
    the newest, is gone from the ledger as from gold."""
    t = 1704067200000
    parts = make_raw(spark, [(meta(t + 1), trade(t=1, T=t)), (meta(t + 2), trade(t=2, T=t + 600_000))]).withColumn("part", F.lit(0)).unionByName(
        make_raw(spark, [(meta(t + 9), trade(t=2, T=t + 60_000))]).withColumn("part", F.lit(1)))
    layout = new_layout(spark)
    apply_parts(spark, parts, [0, 1], layout)
    same_as_scans(spark, layout, parts)
    assert checks.ledger_minutes(stg.read_ledger(spark, layout)).count() == 2


def test_a_batch_without_valid_rows_still_counts_its_raw_rows(spark):
    t = 1704067200000
    bad = make_raw(spark, [(meta(t), trade(t=1, T=t, p="x")), (meta(t), trade(t=2, T=t + 5000, q=None))])
    layout = new_layout(spark)
    for _ in range(2):
        mt.upsert_batch(bad, 0, layout, "t")
    ledger = stg.read_ledger(spark, layout)
    assert ledger.agg(F.sum("raw_rows")).first()[0] == 2
    same_as_scans(spark, layout, bad)


def test_lags_read_the_ledger_alone(spark):
    layout = new_layout(spark)
    ledger = stg.read_ledger(spark, layout)
    assert checks.ledger_layer_lag(ledger, AS_OF).first()["silver_latest"] is None
    mt.upsert_batch(make_raw(spark, [(meta(1704067200000), trade())]), 0, layout, "t")
    for df in (checks.ledger_layer_lag(stg.read_ledger(spark, layout), AS_OF), checks.ledger_silver_lag(stg.read_ledger(spark, layout), AS_OF)):
        files = df.inputFiles()
        assert files and all("/ledger/" in f for f in files)
