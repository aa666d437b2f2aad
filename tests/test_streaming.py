"""Watermark-bounded bars (T3) and the raw-layer sink."""

import datetime as dt
import os

from conftest import SF_SMALL, meta, trade
from pyspark.sql import functions as F

from barforge.session import fresh_dir
from barforge.sources.topic import RAW_SCHEMA
from barforge.streaming import bars

T0 = 1704067200000


def _feed(spark, raw, src, out, chk, parts, final=False):
    for rows in parts:
        raw(rows).write.mode("append").parquet(src)
        stream = spark.readStream.schema(RAW_SCHEMA).parquet(src)
        writer = bars.write_bars_final if final else bars.write_bars_table
        writer(bars.stream_bars(stream, "2 minutes"), out, chk,
               trigger={"availableNow": True}).awaitTermination()


def test_first_copy_wins_and_late_rows_are_dropped(spark, raw):
    root = fresh_dir(spark, "t3")
    src, out, chk = (os.path.join(root, x) for x in ("raw", "bars", "chk"))
    parts = [
        [(meta(T0 + 1), trade(t=1, q="1", T=T0)), (meta(T0 + 2), trade(t=2, q="1", T=T0 + 1000))],
        [(meta(T0 + 3), trade(t=1, q="5", T=T0)),                       # redelivered: ignored
         (meta(T0 + 4), trade(t=3, q="1", T=T0 + 10 * 60000))],         # moves the watermark
        [(meta(T0 + 5), trade(t=4, q="1", T=T0 + 2000))],               # later than the watermark
    ]
    _feed(spark, raw, src, out, chk, parts)
    got = {(str(r.minute_bucket), r.trade_count, str(r.total_quantity))
           for r in bars.read_bars(spark, out).collect()}
    assert got == {("2024-01-01 00:00:00", 2, "2.000000000000000000"),
                   ("2024-01-01 00:10:00", 1, "1.000000000000000000")}


def test_append_mode_emits_closed_minutes_only(spark, raw):
    root = fresh_dir(spark, "t3a")
    src, out, chk = (os.path.join(root, x) for x in ("raw", "bars", "chk"))
    parts = [[(meta(T0 + 1), trade(t=1, T=T0))],
             [(meta(T0 + 2), trade(t=2, T=T0 + 10 * 60000))],
             [(meta(T0 + 3), trade(t=3, T=T0 + 11 * 60000))]]
    _feed(spark, raw, src, out, chk, parts, final=True)
    got = sorted(r.minute_bucket for r in spark.read.parquet(out).collect())
    assert got == [dt.datetime(2024, 1, 1, 0, 0)]


def test_stream_bars_on_fixture_equal_bars_of_first_copies(spark):
    from barforge.operators.gold import gold_trades_1m
    from barforge.operators.silver import parse_trades, valid_trades
    from barforge.sources import fixtures
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = bars.run_stream_bars(spark, events, fresh_dir(spark, "t3f"))
    m = fixtures.trade_messages(events).filter("copy = 0")
    firsts = valid_trades(parse_trades(m.select(F.parse_json("metadata").alias("record_metadata"),
                                                F.parse_json("content").alias("record_content"))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, gold_trades_1m(firsts).collect()))


def test_topic_stream_to_bronze_and_quarantine(spark):
    from barforge.operators.admission import admit_trades
    from barforge.sources import fixtures
    from barforge.sources.topic import (read_bronze, read_quarantine, read_trades_stream,
                                        write_bronze)
    root = fresh_dir(spark, "s6")
    topic = fixtures.topic_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    topic.write.parquet(os.path.join(root, "topic"))
    stream = read_trades_stream(spark, "files", os.path.join(root, "topic"), max_per_trigger=1)
    write_bronze(stream, os.path.join(root, "bronze"), os.path.join(root, "chk"),
                 trigger={"availableNow": True}).awaitTermination()
    bronze = read_bronze(spark, os.path.join(root, "bronze"))
    admitted, rejected = admit_trades(topic)
    assert bronze.count() == admitted.count()
    q = read_quarantine(spark, os.path.join(root, "bronze"))
    assert q.count() == rejected.count()
    assert {r.reason for r in q.select("reason").distinct().collect()} == \
        {r.reason for r in rejected.select("reason").distinct().collect()}
    assert q.filter("raw_value IS NULL").count() == 0
    meta_keys = bronze.select(F.variant_get("record_metadata", "$.CreateTime", "bigint").alias("c"))
    assert meta_keys.filter("c IS NULL").count() == 0
    assert bronze.filter("ingest_date IS NULL").count() == 0


def test_full_pipeline_equals_bars_of_admitted_trades(spark):
    from barforge.operators.admission import admit_trades
    from barforge.operators.gold import gold_trades_1m
    from barforge.operators.silver import silver_trades
    from barforge.plans.catalog import q_ingest_to_gold, topic
    from barforge.sources.topic import to_bronze
    got = q_ingest_to_gold(spark, SF_SMALL)
    admitted, _ = admit_trades(topic(spark, SF_SMALL))
    want = gold_trades_1m(silver_trades(to_bronze(admitted)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_topic_files_read_in_batch_keep_the_kafka_schema(spark):
    from barforge.sources import fixtures
    from barforge.sources.topic import read_topic
    root = fresh_dir(spark, "topic")
    fixtures.topic_rows(spark.read.parquet(f"{SF_SMALL}/events.parquet")).write.parquet(root + "/t")
    t = read_topic(spark, root + "/t")
    assert t.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    assert t.count() == 1120
    assert read_topic(spark, root + "/t", topic="other").count() == 0
