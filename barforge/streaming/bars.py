"""Watermark-bounded one-minute bars (approximate).

Unlike :mod:`barforge.streaming.maintain`, this variant keeps the *first*
copy of a key seen within the watermark and drops rows later than the
watermark, so it equals the exact bars only when copies arrive after their
originals and nothing is later than ``delay``.  It is the cheap option when
corrections never arrive late: state is bounded by the watermark.  Sinks:
:func:`write_bars_table` (update mode, keyed upsert, open minutes visible)
or :func:`write_bars_final` (append mode, closed minutes only).
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.decimal import with_limbs
from barforge.functions.timefn import epoch_ntz, ntz_epoch_micros
from barforge.operators.gold import GOLD_COLUMNS, bar_aggregates
from barforge.operators.silver import parse_trades, valid_trades
from barforge.sources import fixtures
from barforge.streaming import storage as st
from barforge.streaming.maintain import stream_tag


def to_instant(t):
    """TIMESTAMP_NTZ (UTC wall clock) -> TIMESTAMP, zone-proof (watermarks need TIMESTAMP)."""
    return F.timestamp_micros(ntz_epoch_micros(t))


def to_wall_clock(ts):
    """TIMESTAMP -> TIMESTAMP_NTZ in UTC, zone-proof."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch_ntz())


def stream_bars(raw_stream: DataFrame, delay: str = "10 minutes", mode: str = "permissive") -> DataFrame:
    """Watermark -> first-copy de-dup within the watermark -> tumbling one-minute
    window aggregate.  Output columns equal the gold table's."""
    rows = valid_trades(parse_trades(raw_stream, mode)).withColumn(
        "event_ts", to_instant(F.col("trade_time")))
    firsts = (rows.withWatermark("event_ts", delay)
              .dropDuplicatesWithinWatermark(["symbol", "trade_id"]))
    bars = with_limbs(firsts).groupBy("symbol", F.window("event_ts", "1 minute").alias("w")).agg(*bar_aggregates())
    return bars.select("symbol", to_wall_clock(F.col("w.start")).alias("minute_bucket"),
                       *GOLD_COLUMNS[2:])


def write_bars_final(bars: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append-mode sink: a bar is written once, when the watermark passes its
    minute (exactly-once file sink).  Bars still inside the watermark delay
    are not written yet."""
    return (bars.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


BARS_DDL = ("symbol string, minute_bucket timestamp_ntz, trade_count bigint,"
            " total_quantity decimal(38,18), total_notional decimal(38,18),"
            " avg_price decimal(38,18), min_price decimal(38,18), max_price decimal(38,18),"
            " first_trade_time timestamp_ntz, last_trade_time timestamp_ntz, minute_date date,"
            " symbol_key string")
BARS_KEY = ("symbol", "minute_bucket")


def write_bars_table(bars: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Update-mode sink: each micro-batch carries the complete new value of
    every bar it changed, so the bars replace theirs by key in a table
    partitioned by ``(minute_date, symbol)``.  Only touched partitions are
    read and rewritten; the batch is staged first, so a replay re-publishes
    the same content.  Open minutes are visible too."""
    if not st.exists(bars.sparkSession, path):
        bars.sparkSession.createDataFrame([], BARS_DDL).write.partitionBy(*st.GOLD_PARTS) \
            .parquet(path)
    staging = os.path.join(os.path.dirname(path.rstrip("/")), "_staging_bars",
                           stream_tag(checkpoint))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage_path = os.path.join(staging, str(batch_id))
        if not st.complete(spark, stage_path):
            changed = st.with_minute_date(batch).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                parts = st.distinct_keys(changed, st.GOLD_PARTS)
                if not parts:
                    return
                current = st.read_partitions(spark, path, BARS_DDL, st.GOLD_PARTS, parts)
                kept = current.join(changed.select(*BARS_KEY), list(BARS_KEY), "left_anti")
                st.stage(kept.unionByName(changed.select(*GOLD_COLUMNS, "minute_date", "symbol_key")),
                         stage_path, st.GOLD_PARTS)
            finally:
                changed.unpersist()
        st.publish(spark.read.schema(BARS_DDL).parquet(stage_path), path, st.GOLD_PARTS)
        st.drop_older_stages(spark, staging, batch_id)

    return (bars.writeStream.outputMode("update").foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BARS_DDL).parquet(path).select(*GOLD_COLUMNS)


def run_stream_bars(spark: SparkSession, events: DataFrame, root: str,
                    delay: str = "10 minutes", final: bool = False) -> DataFrame:
    """Feed originals in trade-time order, then the redelivered and stale
    copies, one part per catch-up of a single query; return the final bars."""
    from barforge.sources.arrivals import Arrivals
    out, chk = os.path.join(root, "bars"), os.path.join(root, "checkpoint")
    arrivals = Arrivals(spark, fixtures.bronze_parts(events, "time_then_copies"), root)
    write = write_bars_final if final else write_bars_table
    q = write(stream_bars(arrivals.stream(), delay), out, chk, trigger={"processingTime": "200 milliseconds"})
    try:
        for p in range(fixtures.part_count("time_then_copies")):
            arrivals.deliver(p)
            q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(out).select(*GOLD_COLUMNS) if final else read_bars(spark, out)
