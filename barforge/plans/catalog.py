"""Named query plans over the driver's tables (what ``__spark_entry__``
registers).  Every plan reads the given parquet tables, or data Spark
derives from them, so its work grows with the tables.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators import admission, checks
from barforge.functions.decimal import limb_total, with_limbs
from barforge.functions.timefn import ntz_epoch_micros
from barforge.operators.gold import gold_trades_1m
from barforge.operators.silver import cast_rejects, parse_trades, silver_trades, valid_trades
from barforge.session import fresh_dir, written_table
from barforge.sources import fixtures
from barforge.sources.arrivals import Arrivals
from barforge.sources.segments import write_segments
from barforge.sources.topic import TOPIC_SCHEMA, read_bronze, read_rejected_fields, read_trades_stream, write_bronze
from barforge.streaming import bars as stream_bars_mod
from barforge.streaming import late, lifecycle, streams
from barforge.streaming import maintain as mt
from barforge.streaming import storage as st

# Fixed parameters of the registered checks: the clock they are evaluated
# at, the metering day and warehouse, and the subscribed symbols.
TRADES_AS_OF = "2024-01-01 12:00:00"
METERING_AS_OF = "1998-08-02 00:00:00"
METERING_WAREHOUSE = "WH_1"
SUBSCRIBED = ("btcusdt", "ethusdt")
# Offsets a segment of the topic log holds, and a batch of the ingest at most.
SEGMENT_OFFSETS, INGEST_OFFSETS = 50_000, 200_000
RUN_ID = "scheduled__2024-01-01T12:00:00"
LOG_ROOT = "logs"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bronze(spark, sf_dir) -> DataFrame:
    return fixtures.bronze_from_events(table(spark, sf_dir, "events"))


def silver(spark, sf_dir) -> DataFrame:
    return silver_trades(bronze(spark, sf_dir))


def gold(spark, sf_dir) -> DataFrame:
    return gold_trades_1m(silver(spark, sf_dir))


def topic(spark, sf_dir) -> DataFrame:
    return fixtures.topic_rows(table(spark, sf_dir, "events"))


def metering(spark, sf_dir) -> DataFrame:
    return fixtures.metering_from_orders(table(spark, sf_dir, "orders"))


def status(spark, sf_dir) -> DataFrame:
    return fixtures.status_from_suppliers(table(spark, sf_dir, "supplier"))


# --- admission ------------------------------------------------------------

def _admitted_view(admitted: DataFrame) -> DataFrame:
    p = F.col("payload")
    return admitted.select(
        "offset", "key", "wrapped",
        F.variant_get(p, "$.s", "string").alias("symbol"),
        F.try_variant_get(p, "$.E", "decimal(38,0)").cast("bigint").alias("event_ms"),
        F.try_variant_get(p, "$.T", "decimal(38,0)").cast("bigint").alias("trade_ms"),
    )


def q_admit_trades(spark, sf_dir):
    admitted, _ = admission.admit_trades(topic(spark, sf_dir))
    return _admitted_view(admitted)


def q_quarantined_trades(spark, sf_dir):
    _, rejected = admission.admit_trades(topic(spark, sf_dir))
    return rejected.select("offset", "key", "reason")


def q_subscribed_trades(spark, sf_dir):
    admitted, _ = admission.admit_trades(topic(spark, sf_dir))
    return admission.filter_symbols(_admitted_view(admitted), SUBSCRIBED)


def q_keyed_trades(spark, sf_dir):
    admitted, _ = admission.admit_trades(topic(spark, sf_dir))
    keyed = admission.to_keyed(admitted.select("payload"))
    v = F.parse_json("value")
    return keyed.select("key", F.variant_get(v, "$.t", "bigint").alias("trade_id"),
                        F.variant_get(v, "$.q", "string").alias("quantity_text"))


def ingest(spark, rows: DataFrame, name: str) -> str:
    """S5 -> S2 -> S6 as a stream over a log of segments, in batches bounded by
    offsets; returns the landing folder."""
    root = fresh_dir(spark, name)
    log, chk = os.path.join(root, "topic"), os.path.join(root, "chk")
    write_segments(rows, log, SEGMENT_OFFSETS)
    # What is left after the last whole flush does not wait: the log is complete.
    stream = read_trades_stream(spark, "segments", log, max_per_trigger=INGEST_OFFSETS, checkpoint=chk, maxTriggerDelay=0)
    q = write_bronze(stream, os.path.join(root, "bronze"), chk, trigger=CATCH_UP)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return os.path.join(root, "bronze")


def q_bronze_ingest(spark, sf_dir):
    """The raw layer after an ingest of the topic."""
    b = read_bronze(spark, ingest(spark, topic(spark, sf_dir), "bronze_ingest"))
    c = F.col("record_content")
    return b.select(F.variant_get("record_metadata", "$.offset", "bigint").alias("offset"),
                    F.variant_get("record_metadata", "$.CreateTime", "bigint").alias("create_ms"),
                    F.variant_get(c, "$.s", "string").alias("symbol"),
                    F.variant_get(c, "$.t", "bigint").alias("trade_id"),
                    F.variant_get(c, "$.q", "string").alias("quantity_text"))


def q_ingest_rejects(spark, sf_dir):
    """F2/F3 in the maintained path: rejected fields that an ingest recorded
    beside its raw rows."""
    rows = fixtures.topic_with_bad_fields(table(spark, sf_dir, "events"))
    lane = read_rejected_fields(spark, ingest(spark, rows, "ingest_rejects"))
    return lane.select(F.variant_get("record_metadata", "$.offset", "bigint").alias("offset"), "field", "value", "reason")


# --- silver / gold ----------------------------------------------------------

def q_parse_trades(spark, sf_dir):
    return parse_trades(bronze(spark, sf_dir))


def q_valid_trades(spark, sf_dir):
    return valid_trades(parse_trades(bronze(spark, sf_dir)))


def q_silver_trades(spark, sf_dir):
    return silver(spark, sf_dir)


def q_gold_trades_1m(spark, sf_dir):
    return gold(spark, sf_dir)


# --- checks -----------------------------------------------------------------

def q_dup_key_groups(spark, sf_dir):
    return checks.check_no_duplicates(silver(spark, sf_dir))


def q_dup_key_groups_valid(spark, sf_dir):
    """M1 over the validated rows before de-dup: the failing case."""
    return checks.check_no_duplicates(valid_trades(parse_trades(bronze(spark, sf_dir))))


def q_null_rows(spark, sf_dir):
    return checks.check_not_nulls(silver(spark, sf_dir))


def q_null_rows_parsed(spark, sf_dir):
    """M2 over the parsed rows before the validity filter: the failing case."""
    return checks.check_not_nulls(parse_trades(bronze(spark, sf_dir)))


def q_recent_activity(spark, sf_dir):
    return checks.check_recent_activity(silver(spark, sf_dir), TRADES_AS_OF)


def q_bronze_recency(spark, sf_dir):
    return checks.check_bronze_recent(bronze(spark, sf_dir), TRADES_AS_OF)


def q_clamped_recency(spark, sf_dir):
    """a window of zero minutes counts as one."""
    return checks.check_bronze_recent(bronze(spark, sf_dir), TRADES_AS_OF, window_minutes=0)


def q_activity_now(spark, sf_dir):
    """the activity check at the current UTC time."""
    return checks.check_recent_activity(silver(spark, sf_dir))


def q_cast_rejects(spark, sf_dir):
    """values that permissive parsing rejects, by field and reason."""
    return cast_rejects(fixtures.bronze_with_bad_fields(table(spark, sf_dir, "events")), ("offset",))


def q_exact_bars(spark, sf_dir):
    """A4 on factors with 18 decimals (derived from the event ids): notional
    per event type, in units of 10^-18."""
    e = table(spark, sf_dir, "events")

    def factor(whole, step):
        units = (F.col("event_id").cast("decimal(20,0)") * F.lit(str(step)).cast("decimal(18,0)")
                 % F.lit(str(10 ** 18)).cast("decimal(19,0)")).cast("decimal(18,0)")
        return F.concat(whole.cast("string"), F.lit("."), F.lpad(units.cast("string"), 18, "0")).cast("decimal(38,18)")

    rows = e.select(F.col("event_type").alias("symbol"),
                    factor(F.col("event_id") * 1000003, 123456789012345677).alias("price"),
                    factor(F.col("event_id") % 97, 987654321098765431).alias("quantity"))
    bars = with_limbs(rows).groupBy("symbol").agg(F.count(F.lit(1)).alias("trade_count"), limb_total().alias("n"))
    return bars.select("symbol", "trade_count", F.replace(F.col("n").cast("string"), F.lit("."), F.lit("")).alias("notional_units"))


def q_silver_lag(spark, sf_dir):
    return checks.check_silver_lag(silver(spark, sf_dir), TRADES_AS_OF)


def layers(spark, sf_dir):
    """Raw and silver as stored tables (each computed once); gold is one
    aggregate over the stored silver."""
    b = written_table(bronze(spark, sf_dir), "bronze")
    s = written_table(silver_trades(b), "silver")
    return b, s, gold_trades_1m(s)


def q_layer_lag(spark, sf_dir):
    return checks.layer_lag(*layers(spark, sf_dir), TRADES_AS_OF)


def q_daily_summary(spark, sf_dir):
    return checks.daily_summary(*layers(spark, sf_dir), TRADES_AS_OF)


def q_daily_credits(spark, sf_dir):
    return checks.check_daily_credits(metering(spark, sf_dir), METERING_AS_OF, METERING_WAREHOUSE)


def q_pipeline_status(spark, sf_dir):
    return checks.check_pipeline_status(status(spark, sf_dir))


def q_quality_suite(spark, sf_dir):
    return checks.quality_suite(written_table(silver(spark, sf_dir), "silver"), TRADES_AS_OF)


def q_health_suite(spark, sf_dir):
    b = written_table(bronze(spark, sf_dir), "bronze")
    return checks.health_suite(status(spark, sf_dir), b, silver_trades(b), TRADES_AS_OF)


def q_check_failures(spark, sf_dir):
    b = written_table(bronze(spark, sf_dir), "bronze")
    s = written_table(silver_trades(b), "silver")
    results = checks.quality_suite(s, TRADES_AS_OF, min_rows=100).unionByName(
        checks.health_suite(status(spark, sf_dir), b, s, TRADES_AS_OF))
    return checks.failures(results, RUN_ID, LOG_ROOT)


def q_quality_until_failure(spark, sf_dir):
    """M9 with a short circuit over the validated rows before de-dup: the
    duplicates fail, so the activity check does not run."""
    return checks.quality_until_failure(written_table(valid_trades(parse_trades(bronze(spark, sf_dir))), "valid"), TRADES_AS_OF)


# --- streaming ----------------------------------------------------------------

# Poll interval while catching up (a zero interval busy-lists the folder).
CATCH_UP = {"processingTime": "200 milliseconds"}


def run_incremental(spark: SparkSession, sf_dir: str, split: str, name: str,
                    block_size: int = st.DEFAULT_BLOCK, stop_after: int | None = None,
                    ) -> tuple[st.Layout, Arrivals, str]:
    """Feed the raw layer to one ``maintain`` query part by part: each part
    arrives in the watched folder and the query catches up before the next."""
    root = fresh_dir(spark, name)
    layout = st.Layout(os.path.join(root, "tables"), block_size)
    chk = os.path.join(root, "checkpoint")
    arrivals = Arrivals(spark, fixtures.bronze_parts(table(spark, sf_dir, "events"), split), root)
    n = fixtures.part_count(split)
    q = mt.maintain(arrivals.stream(), layout, chk, trigger=CATCH_UP,
                    query_name=f"maintain-{mt.stream_tag(chk)}")
    try:
        for p in range(n if stop_after is None else min(stop_after, n)):
            arrivals.deliver(p)
            q.processAllAvailable()
    finally:
        q.stop()
    return layout, arrivals, chk


def q_silver_incremental(spark, sf_dir):
    layout, _, _ = run_incremental(spark, sf_dir, "hash", "silver_incremental")
    return st.read_silver(spark, layout)


def q_gold_incremental(spark, sf_dir):
    layout, _, _ = run_incremental(spark, sf_dir, "redelivered_first", "gold_incremental")
    return st.read_gold(spark, layout)


def q_backfill_gold(spark, sf_dir):
    """Rebuild both layers from all raw rows over a layout that a stream
    has maintained from its first part."""
    layout, arrivals, _ = run_incremental(spark, sf_dir, "copies", "backfill", stop_after=1)
    for p in range(1, fixtures.part_count("copies")):
        arrivals.deliver(p)
    mt.rebuild(arrivals.read(), layout)
    return st.read_gold(spark, layout)


def q_ledger_layer_lag(spark, sf_dir):
    """M11 over a maintained layout, read from its ledger alone."""
    layout, _, _ = run_incremental(spark, sf_dir, "copies", "ledger_layer_lag")
    return checks.ledger_layer_lag(st.read_ledger(spark, layout), TRADES_AS_OF)


def q_ledger_checks(spark, sf_dir):
    """M3 and M5 over a maintained layout, from its ledger."""
    layout, _, _ = run_incremental(spark, sf_dir, "hash", "ledger_checks")
    ledger = st.read_ledger(spark, layout)
    return checks.ledger_silver_lag(ledger, TRADES_AS_OF).unionByName(
        checks.ledger_recent_activity(ledger, st.read_silver(spark, layout), TRADES_AS_OF))


def q_registered_layers(spark, sf_dir):
    """Ingest and maintenance with registered tables; rows and earliest
    trade time (ms) of each layer, read through the catalog."""
    root = fresh_dir(spark, "registered")
    layout = st.Layout(os.path.join(root, "tables"), catalog=f"r{root[-12:]}_")
    arrivals = Arrivals(spark, topic(spark, sf_dir).withColumn("part", F.lit(0)), root, schema=TOPIC_SCHEMA)
    queries = streams.start_streams(spark, arrivals.stream(), layout, os.path.join(root, "checkpoints"),
                                    ingest_trigger=CATCH_UP, maintain_trigger=CATCH_UP, register=True)
    try:
        arrivals.deliver(0)
        streams.catch_up(queries)
    finally:
        for q in queries:
            q.stop()
    st.refresh_tables(spark, layout)
    layers = (("raw", "bronze", "trade_time"), ("silver", "silver", "trade_time"), ("gold", "gold", "first_trade_time"))
    counts = [spark.table(st.table_name(layout, name)).agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("t"))
              .select(F.lit(tag).alias("layer"), "n", (ntz_epoch_micros(F.col("t")) / 1000).cast("bigint").alias("low"))
              for tag, name, t in layers]
    return written_table(reduce(DataFrame.unionByName, counts), "registered")


def q_recover_gold(spark, sf_dir):
    """The stream stops after its first part; more raw files arrive while
    it is down; ``recover`` restarts it from the same checkpoint, it catches
    up, and the health checks must pass."""
    layout, arrivals, chk = run_incremental(spark, sf_dir, "copies", "recover", stop_after=1)
    for p in range(1, fixtures.part_count("copies")):
        arrivals.deliver(p)
    name = f"maintain-{mt.stream_tag(chk)}"

    def start():
        return mt.maintain(arrivals.stream(), layout, chk, trigger=CATCH_UP, query_name=name)

    def validate(query):
        query.processAllAvailable()
        # Status document of the restarted, still running query, then the
        # freshness checks; enforce raises when one fails.
        live = lifecycle.status_from_queries(spark, name, [query])
        return checks.enforce(lifecycle.health_checks(
            live, arrivals.read(), st.read_silver(spark, layout), TRADES_AS_OF))

    try:
        lifecycle.recover(spark, name, start, validate, chk)
    finally:
        lifecycle.stop_query(spark, name)
    return st.read_gold(spark, layout)


def q_ingest_to_gold(spark, sf_dir):
    """Topic messages arrive in four parts; ingest and maintenance streams
    catch up after each.  Gold then equals the bars of every admitted trade."""
    root = fresh_dir(spark, "ingest_to_gold")
    layout = st.Layout(os.path.join(root, "tables"))
    t = topic(spark, sf_dir)
    tagged = t.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(4)))
    arrivals = Arrivals(spark, tagged, root, schema=TOPIC_SCHEMA)
    queries = streams.start_streams(spark, arrivals.stream(), layout,
                                      os.path.join(root, "checkpoints"),
                                      ingest_trigger=CATCH_UP, maintain_trigger=CATCH_UP)
    try:
        for p in range(4):
            arrivals.deliver(p)
            streams.catch_up(queries)
    finally:
        for q in queries:
            q.stop()
    return st.read_gold(spark, layout)


def q_stream_bars_update(spark, sf_dir):
    return stream_bars_mod.run_stream_bars(spark, table(spark, sf_dir, "events"),
                                           fresh_dir(spark, "stream_bars"))


def q_stream_bars_append(spark, sf_dir):
    """T3 in append mode: each bar once, when the watermark has passed it."""
    return stream_bars_mod.run_stream_bars(spark, table(spark, sf_dir, "events"),
                                           fresh_dir(spark, "stream_bars_final"), final=True)


def q_late_settled_bars(spark, sf_dir):
    """Bars closed by the watermark, with the late lane settled in.
    Redelivered copies come first, so most originals are late."""
    root = fresh_dir(spark, "late_settled_bars")
    split = "redelivered_first"
    arrivals = Arrivals(spark, fixtures.bronze_parts(table(spark, sf_dir, "events"), split), root)
    out = os.path.join(root, "out")
    q = late.write_closed_minutes(late.laned_trades(arrivals.stream()), out, os.path.join(root, "chk"), trigger=CATCH_UP)
    try:
        for p in range(fixtures.part_count(split)):
            arrivals.deliver(p)
            q.processAllAvailable()
    finally:
        q.stop()
    return late.settle(late.read_closed_bars(spark, out), late.read_closed_trades(spark, out), late.read_late(spark, out))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "admit_trades": q_admit_trades,
    "quarantined_trades": q_quarantined_trades,
    "subscribed_trades": q_subscribed_trades,
    "keyed_trades": q_keyed_trades,
    "bronze_ingest": q_bronze_ingest,
    "ingest_rejects": q_ingest_rejects,
    "parse_trades": q_parse_trades,
    "valid_trades": q_valid_trades,
    "silver_trades": q_silver_trades,
    "gold_trades_1m": q_gold_trades_1m,
    "dup_key_groups": q_dup_key_groups,
    "dup_key_groups_valid": q_dup_key_groups_valid,
    "null_rows": q_null_rows,
    "null_rows_parsed": q_null_rows_parsed,
    "recent_activity": q_recent_activity,
    "bronze_recency": q_bronze_recency,
    "clamped_recency": q_clamped_recency,
    "activity_now": q_activity_now,
    "cast_rejects": q_cast_rejects,
    "exact_bars": q_exact_bars,
    "silver_lag": q_silver_lag,
    "layer_lag": q_layer_lag,
    "daily_summary": q_daily_summary,
    "daily_credits": q_daily_credits,
    "pipeline_status": q_pipeline_status,
    "quality_suite": q_quality_suite,
    "health_suite": q_health_suite,
    "check_failures": q_check_failures,
    "quality_until_failure": q_quality_until_failure,
    "silver_incremental": q_silver_incremental,
    "gold_incremental": q_gold_incremental,
    "ledger_layer_lag": q_ledger_layer_lag,
    "ledger_checks": q_ledger_checks,
    "backfill_gold": q_backfill_gold,
    "recover_gold": q_recover_gold,
    "stream_bars_update": q_stream_bars_update,
    "stream_bars_append": q_stream_bars_append,
    "late_settled_bars": q_late_settled_bars,
    "registered_layers": q_registered_layers,
    "ingest_to_gold": q_ingest_to_gold,
}
