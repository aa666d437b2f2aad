"""Bars closed by the watermark, and the lane of late rows."""

import os

from conftest import SF_SMALL, meta, trade
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barforge.operators.gold import gold_trades_1m
from barforge.operators.silver import silver_trades
from barforge.session import fresh_dir
from barforge.sources import fixtures
from barforge.sources.arrivals import Arrivals
from barforge.sources.topic import RAW_SCHEMA
from barforge.streaming import late

T0 = 1704067200000


def _feed(spark, raw, root, parts, restart=True):
    src, out, chk = (os.path.join(root, x) for x in ("raw", "out", "chk"))
    for rows in parts:
        raw(rows).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(RAW_SCHEMA).parquet(src)
        late.write_closed_minutes(late.laned_trades(stream, "2 minutes"), out, chk,
                                  trigger={"availableNow": True}).awaitTermination()
    return out


def test_late_rows_reach_the_lane_and_settle_to_exact_bars(spark, raw):
    parts = [
        [(meta(T0 + 1), trade(t=1, q="1", T=T0)), (meta(T0 + 2), trade(t=2, q="1", T=T0 + 1000)),
         (meta(T0 + 3), trade(t=1, q="5", T=T0))],                      # a later copy before the close wins
        [(meta(T0 + 4), trade(t=3, q="1", T=T0 + 10 * 60000))],         # the watermark passes minute 0
        [(meta(T0 + 5), trade(t=4, q="2", T=T0 + 2000)),                # a new trade, late
         (meta(T0 + 6), trade(t=2, q="7", T=T0 + 1000)),                # a late copy
         (meta(T0 + 7), trade(t=5, q="1", T=T0 + 3 * 60000)),           # a late minute without a bar
         (meta(T0 + 8), trade(t=6, s="ETHUSDT", q="1", T=T0 + 20 * 60000))],
        [(meta(T0 + 9), trade(t=7, q="1", T=T0 + 40 * 60000))],
    ]
    out = _feed(spark, raw, fresh_dir(spark, "late"), parts)
    assert sorted(r.trade_id for r in late.read_late(spark, out).collect()) == [2, 4, 5]
    closed = {(r.symbol, str(r.minute_bucket)): (r.trade_count, str(r.total_quantity)) for r in late.read_closed_bars(spark, out).collect()}
    assert closed[("BTCUSDT", "2024-01-01 00:00:00")] == (2, "6.000000000000000000")
    settled = late.settle(late.read_closed_bars(spark, out), late.read_closed_trades(spark, out), late.read_late(spark, out))
    everything = raw([r for p in parts for r in p])
    exact = gold_trades_1m(silver_trades(everything)).filter(F.col("minute_bucket") < F.lit("2024-01-01 00:40:00").cast("timestamp_ntz"))
    assert sorted(map(tuple, settled.collect())) == sorted(map(tuple, exact.collect()))


def test_fixture_bars_and_lane_equal_the_exact_bars(spark):
    root = fresh_dir(spark, "latefix")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    arrivals = Arrivals(spark, fixtures.bronze_parts(events, "redelivered_first"), root)
    q = late.write_closed_minutes(late.laned_trades(arrivals.stream(), "10 minutes"), os.path.join(root, "out"),
                                  os.path.join(root, "chk"), trigger={"processingTime": "200 milliseconds"})
    try:
        for p in range(fixtures.part_count("redelivered_first")):
            arrivals.deliver(p)
            q.processAllAvailable()
    finally:
        q.stop()
    out = os.path.join(root, "out")
    lane = late.read_late(spark, out)
    assert lane.count() > 0
    settled = late.settle(late.read_closed_bars(spark, out), late.read_closed_trades(spark, out), lane)
    exact = gold_trades_1m(silver_trades(arrivals.read()))
    last = exact.agg(F.max("last_trade_time")).first()[0]
    closed = exact.filter(F.col("minute_bucket") + F.expr("interval 11 minutes") <= F.lit(last))
    assert sorted(map(tuple, settled.collect())) == sorted(map(tuple, closed.collect()))


def test_empty_layers(spark):
    root = fresh_dir(spark, "lateempty")
    assert late.settle(late.read_closed_bars(spark, root), late.read_closed_trades(spark, root), late.read_late(spark, root)).count() == 0


def test_copies_travel_as_lines_and_come_back_whole(spark):
    """The state keeps a minute's copies as texts of at most CHUNK lines; none
    of their values changes on the way."""
    rows = spark.sql(f"""select * from values
        ('trade', timestamp_ntz'2024-01-01 00:00:00.005', 'A\\n"B', 1L, 99999999999999999999.999999999999999999BD, 0.000000000000000001BD, null, 2L, timestamp_ntz'0001-01-01 00:00:00', true, timestamp_ntz'9999-12-31 23:59:59.999'),
        (null, null, '', -9223372036854775807L, -1BD, 0BD, 1L, null, timestamp_ntz'1969-12-31 23:59:59.999', null, null)
        as t({', '.join(late.TRADE_KINDS) })""").to(StructType.fromDDL(late.TRADES_DDL))
    held = rows.select(late._packed().alias("copy"))
    texts = list(late._chunks(iter(held.collect() * 1024)))
    assert [t.count("\n") + 1 for t in texts] == [late.CHUNK, late.CHUNK]
    back = late._unpacked(spark.createDataFrame([(texts[0], late.CLOSED)], "copies string, lane string"))
    assert sorted(map(str, back.drop("lane").distinct().collect())) == sorted(map(str, rows.collect())) and back.count() == late.CHUNK
