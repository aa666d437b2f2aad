"""One-minute bars closed by the watermark, with a lane for late rows.

:mod:`barforge.streaming.bars` drops what arrives behind its watermark.  Here
each (symbol, minute) keeps its copies in state until the watermark passes the
minute's end; a timer then hands them on, and whatever arrives after that goes
to the late lane as it is, so nothing is lost::

    raw stream -> typed, valid -> transformWithState -> closed -> keep-latest -> trades, bars
                                                     -> late lane

A minute's state is dealt over ``BUCKETS`` keys by trade id, so a hot minute is
not one key; their timers fall due together, so a minute closes in one batch.
Python moves a copy as one line of JSON and the state holds many lines in a
text, so what a copy costs there does not depend on its columns.
Keep-latest is silver's rule over the copies a minute holds when it closes.
:func:`settle` adds the lane: bars it touches are made again from their stored
trades and the late rows, and then equal the exact bars of all rows.

A copy that names another minute than its original counts in both (only the
maintained path moves trades between minutes).  Minutes whose end the watermark
has not passed are not written yet.  A replayed batch writes its own folders
again.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from itertools import islice

from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from barforge.functions.timefn import epoch_ntz, minute_bucket, ntz_epoch_micros
from barforge.operators.gold import GOLD_COLUMNS, gold_trades_1m
from barforge.operators.silver import PARSED_COLUMNS, dedup_latest, parse_trades, valid_trades
from barforge.streaming import storage as st
from barforge.streaming.bars import BARS_DDL, to_instant

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 16
TRADES_DDL = ("event_type string, event_time timestamp_ntz, symbol string, trade_id bigint,"
              " price decimal(38,18), quantity decimal(38,18), buyer_order_id bigint,"
              " seller_order_id bigint, trade_time timestamp_ntz, is_maker boolean,"
              " ingested_at timestamp_ntz")
TRADE_KINDS = dict(column.split(" ") for column in TRADES_DDL.split(", "))
#: Copies in a text of the state.
CHUNK = 1024
CLOSED, LATE = "closed", "late"
TRADES, BARS = "trades", "bars"
BAR_DDL = ", ".join(c for c in BARS_DDL.split(", ") if not c.startswith(("minute_date", "symbol_key")))
MINUTE_MS = 60_000
# Fixed value: the state store that timers and list state need.
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def _packed() -> Column:
    """A trade as one line of JSON: Python hands it on without reading it.
    Times are microseconds and decimals are text, so nothing is lost."""
    def plain(name: str, kind: str) -> Column:
        c = F.col(name)
        return (ntz_epoch_micros(c) if kind == "timestamp_ntz" else c.cast("string") if kind.startswith("decimal") else c).alias(name)
    return F.to_json(F.struct(*[plain(*x) for x in TRADE_KINDS.items()]))


def _unpacked(laned: DataFrame) -> DataFrame:
    """Lines of JSON as typed rows with their lane."""
    def told(kind: str) -> str:
        return "bigint" if kind == "timestamp_ntz" else "string" if kind.startswith("decimal") else kind

    def typed(name: str, kind: str) -> Column:
        c = F.col(f"t.{name}")
        return (F.timestamp_add("MICROSECOND", c, epoch_ntz()) if kind == "timestamp_ntz" else c.cast(kind)).alias(name)

    ddl = ", ".join(f"{name} {told(kind)}" for name, kind in TRADE_KINDS.items())
    lines = laned.select(F.explode(F.split("copies", "\n")).alias("line"), "lane")
    rows = lines.select(F.inline(F.array(F.struct(F.from_json("line", ddl).alias("t"), F.col("lane").alias("lane")))))
    return rows.select(*[typed(*x) for x in TRADE_KINDS.items()], "lane")


def _chunks(rows: Iterator[Row]) -> Iterator[str]:
    """The rows' lines, at most CHUNK in a text."""
    while some := [r["copy"] for r in islice(rows, CHUNK)]:
        yield "\n".join(some)


class CloseMinutes(StatefulProcessor):
    """Holds a minute's copies, as texts of many lines; the key is (symbol,
    minute start in ms, bucket)."""

    def init(self, handle) -> None:
        self.handle = handle
        self.copies = handle.getListState("copies", "copies string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end = key[1] + MINUTE_MS
        is_open = self.copies.exists()
        if not is_open and end <= timerValues.getCurrentWatermarkInMs():
            for text in _chunks(rows):
                yield Row(copies=text, lane=LATE)
            return
        if not is_open:
            self.handle.registerTimer(end)
        self.copies.appendList([(text,) for text in _chunks(rows)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for (text,) in self.copies.get():
            yield Row(copies=text, lane=CLOSED)
        self.copies.clear()

    def close(self) -> None:
        """No resources of its own."""


def laned_trades(raw_stream: DataFrame, delay: str = "10 minutes", mode: str = "permissive") -> DataFrame:
    """Typed, valid rows with their lane: all copies of a minute when it
    closes, and each row that came after that."""
    rows = valid_trades(parse_trades(raw_stream, mode)).withColumn("event_ts", to_instant(F.col("trade_time")))
    # The engine filters late rows by the watermarked column, so the keyed rows
    # leave it behind; the watermark itself goes on.
    keyed = rows.withWatermark("event_ts", delay).select(
        "symbol", _packed().alias("copy"),
        F.expr(f"{MINUTE_MS} * floor(unix_micros(event_ts) / {MINUTE_MS * 1000})").cast("bigint").alias("minute_ms"),
        F.pmod(F.xxhash64("trade_id"), F.lit(BUCKETS)).alias("bucket"))
    return _unpacked(keyed.groupBy("symbol", "minute_ms", "bucket").transformWithState(
        statefulProcessor=CloseMinutes(), outputStructType="copies string, lane string", outputMode="Append", timeMode="EventTime"))


def _folder(root: str, name: str, batch_id: int) -> str:
    return os.path.join(root, name, f"batch={batch_id}")


def write_closed_minutes(laned: DataFrame, root: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """Bars, their trades and the late lane as folders of ``root``, one
    sub-folder a batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trades = dedup_latest(held.filter(F.col("lane") == CLOSED).drop("lane"))
            parts = {TRADES: trades, LATE: held.filter(F.col("lane") == LATE).drop("lane"),
                     BARS: gold_trades_1m(trades)}
            for name, rows in parts.items():
                (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
                 .parquet(_folder(root, name, batch_id)))
        finally:
            held.unpersist()

    spark = laned.sparkSession
    before = spark.conf.get(PROVIDER_KEY)
    spark.conf.set(PROVIDER_KEY, STATE_PROVIDER)       # a query keeps the settings it starts with
    try:
        return (laned.writeStream.outputMode("append").foreachBatch(run)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "60 seconds"})).start())
    finally:
        spark.conf.set(PROVIDER_KEY, before)


def _read(spark: SparkSession, root: str, name: str, ddl: str) -> DataFrame:
    path = os.path.join(root, name)
    if not st.exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("recursiveFileLookup", "true").parquet(path)


def read_closed_bars(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, BARS, BAR_DDL).select(*GOLD_COLUMNS)


def read_closed_trades(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, TRADES, TRADES_DDL)


def read_late(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, LATE, TRADES_DDL)


def settle(bars: DataFrame, trades: DataFrame, late: DataFrame) -> DataFrame:
    """Closed bars with the late lane added: bars of touched (symbol, minute)
    are made again from their trades and the late rows, the others stay."""
    key = ["symbol", "minute_bucket"]
    minute = minute_bucket(F.col("trade_time")).alias("minute_bucket")
    late = late.select("*", minute)
    touched = late.select(*key).distinct()
    again = trades.select("*", minute).join(touched, key, "left_semi").unionByName(late).drop("minute_bucket")
    # A late copy replaces its original only inside its own minute.
    per_minute = dedup_latest(again.withColumn("_minute", minute_bucket(F.col("trade_time"))), ("symbol", "trade_id", "_minute"))
    return bars.join(touched, key, "left_anti").select(*GOLD_COLUMNS).unionByName(gold_trades_1m(per_minute))
