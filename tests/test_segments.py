"""The segment log as a streaming source: offsets, restarts, limits, flush rule."""

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from barforge.session import fresh_dir
from barforge.sources import fixtures, segments
from barforge.sources.topic import read_bronze, read_trades_stream, write_bronze


def _rows(spark, partition, offsets, topic="crypto_trades"):
    return (spark.createDataFrame([(int(o),) for o in offsets], "offset bigint")
            .select(F.lit("K").alias("key"), F.concat(F.lit("v"), "offset").alias("value"), F.lit(topic).alias("topic"),
                    F.lit(partition).cast("int").alias("partition"), "offset", F.timestamp_millis(F.col("offset")).alias("timestamp")))


def _drain(spark, log, out, chk, **options):
    q = (segments.read_segments_stream(spark, log, "crypto_trades", **options).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", chk).trigger(processingTime="100 milliseconds").start())
    try:
        q.processAllAvailable()
        return [p.numInputRows for p in q.recentProgress if p.numInputRows]
    finally:
        q.stop()


def _got(spark, out):
    return sorted((r.partition, r.offset, r.value) for r in spark.read.parquet(out).collect())


def test_restart_goes_on_from_recorded_offsets(spark):
    root = fresh_dir(spark, "seg").removeprefix("file://")
    log, out, chk = (os.path.join(root, x) for x in ("log", "out", "chk"))
    first = list(range(0, 25)) + [40, 41]                      # a gap, and a segment half full
    segments.write_segments(_rows(spark, 0, first), log, 10)
    segments.write_segments(_rows(spark, 1, range(5)), log, 10)
    segments.write_segments(_rows(spark, 1, range(10, 12), topic="other"), log, 10)
    assert sum(_drain(spark, log, out, chk)) == len(first) + 5
    assert segments.last_planned(chk) == {"0": 42, "1": 12}
    segments.write_segments(_rows(spark, 0, range(50, 53)), log, 10)
    segments.write_segments(_rows(spark, 7, range(100, 102)), log, 10)   # a partition that comes later
    assert sum(_drain(spark, log, out, chk)) == 5
    want = [(0, o) for o in first + [50, 51, 52]] + [(1, o) for o in range(5)] + [(7, 100), (7, 101)]
    assert [(p, o) for p, o, _ in _got(spark, out)] == sorted(want)


def test_limit_bounds_batches_also_after_a_restart(spark):
    root = fresh_dir(spark, "seglim").removeprefix("file://")
    log, out, chk = (os.path.join(root, x) for x in ("log", "out", "chk"))
    segments.write_segments(_rows(spark, 0, range(30)).union(_rows(spark, 1, range(10))), log, 10)
    sizes = _drain(spark, log, out, chk, maxOffsetsPerTrigger=16, checkpoint=chk)
    assert max(sizes) <= 16 and sum(sizes) == 40
    segments.write_segments(_rows(spark, 0, range(30, 60)), log, 10)
    sizes = _drain(spark, log, out, chk, maxOffsetsPerTrigger=16, checkpoint=chk)
    assert max(sizes) <= 16 and sum(sizes) == 30
    assert len(_got(spark, out)) == 70 == len(set(_got(spark, out)))


def test_empty_log_and_missing_checkpoint(spark):
    root = fresh_dir(spark, "segempty").removeprefix("file://")
    assert segments.SegmentReader({"path": root}).latestOffset() == {}
    assert segments.last_planned(root) is None
    with pytest.raises(ValueError):
        segments.SegmentReader({"path": root, "maxOffsetsPerTrigger": "5"})
    with pytest.raises(ValueError):
        read_trades_stream(spark, "segments")


def test_flush_rule_cuts_at_records_bytes_or_time(spark):
    root = fresh_dir(spark, "segflush").removeprefix("file://")
    log, chk = os.path.join(root, "log"), os.path.join(root, "chk")
    segments.write_segments(_rows(spark, 0, range(10)), log, 10)

    def reader(**more):
        return segments.SegmentReader({"path": log, "checkpoint": chk, "minOffsetsPerTrigger": "20",
                                       "minBytesPerTrigger": "1000000000", "maxTriggerDelay": "3600", **more})
    r = reader()
    assert r.latestOffset() == {}                              # ten records wait
    segments.write_segments(_rows(spark, 0, range(10, 20)), log, 10)
    assert r.latestOffset() == {"0": 20}                       # twenty are a flush
    segments.write_segments(_rows(spark, 0, range(20, 21)), log, 10)
    assert r.latestOffset() == {"0": 20}
    assert reader(minBytesPerTrigger="1").latestOffset() == {"0": 21}
    assert reader(minOffsetsPerTrigger="100", maxTriggerDelay="0").latestOffset() == {"0": 21}


def test_deal_is_proportional_and_whole():
    assert segments.deal({"0": 30, "1": 10}, 16) == {"0": 12, "1": 4}
    assert segments.deal({"0": 3, "1": 3}, 100) == {"0": 3, "1": 3}
    shares = segments.deal({"0": 1, "1": 1, "2": 1000}, 7)
    assert sum(shares.values()) == 7 and all(v <= m for v, m in zip(shares.values(), (1, 1, 1000)))


def test_ingest_through_segments_equals_ingest_of_files(spark):
    from barforge.operators.admission import admit_trades
    root = fresh_dir(spark, "segingest").removeprefix("file://")
    topic = fixtures.topic_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    segments.write_segments(topic, os.path.join(root, "log"), 500)
    chk, out = os.path.join(root, "chk"), os.path.join(root, "bronze")
    stream = read_trades_stream(spark, "segments", os.path.join(root, "log"), max_per_trigger=1200, checkpoint=chk,
                                maxTriggerDelay=0)
    q = write_bronze(stream, out, chk, trigger={"processingTime": "100 milliseconds"})
    try:
        q.processAllAvailable()
        assert sum(1 for p in q.recentProgress if p.numInputRows) >= 2
    finally:
        q.stop()
    admitted, _ = admit_trades(topic)
    assert read_bronze(spark, out).count() == admitted.count()
