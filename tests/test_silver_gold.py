import datetime as dt
from decimal import Decimal

from conftest import meta, trade
from pyspark.sql import functions as F

from barforge.operators.gold import gold_trades_1m
from barforge.operators.silver import SILVER_COLUMNS, parse_trades, silver_trades

T0 = 1704067200000  # 2024-01-01 00:00:00


def test_parse_reads_both_cases_and_metadata_fallbacks(spark, raw):
    rows = [
        (meta(T0 + 100), trade(t=1)),
        (meta(T0 + 200, "createTime"), trade(t=2)),
        (meta(T0 + 300, "CREATETIME"), trade(t=3)),
        (meta(), trade(t=4, E=T0 + 400)),
        (meta(), trade(t=5, E="bad", T=T0 + 500)),
    ]
    got = {r.trade_id: r.ingested_at for r in parse_trades(raw(rows)).collect()}
    ms = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=k)
    assert got == {1: ms(100), 2: ms(200), 3: ms(300), 4: ms(400), 5: ms(500)}


def test_text_E_is_accepted_by_silver(spark, raw):
    r = parse_trades(raw([(meta(T0), trade(E=str(T0 + 7)))])).first()
    assert r.event_time == dt.datetime(2024, 1, 1, 0, 0, 0, 7000)


def test_latest_copy_wins(spark, raw):
    rows = [(meta(T0 + 10), trade(q="1.0")), (meta(T0 + 30), trade(q="3.0")),
            (meta(T0 + 20), trade(q="2.0"))]
    [r] = silver_trades(raw(rows)).collect()
    assert r.quantity == Decimal("3.0")


def test_invalid_later_copy_does_not_displace_valid_row(spark, raw):
    rows = [(meta(T0 + 10), trade(p="1.25")), (meta(T0 + 99), trade(p="N/A"))]
    [r] = silver_trades(raw(rows)).collect()
    assert r.price == Decimal("1.25")


def test_ties_resolve_the_same_whatever_the_order(spark, raw):
    a, b = (meta(T0 + 10), trade(q="1.0")), (meta(T0 + 10), trade(q="2.0"))
    one = silver_trades(raw([a, b])).first()
    two = silver_trades(raw([b, a])).first()
    assert one.quantity == two.quantity == Decimal("2.0")


def test_silver_schema(spark, raw):
    df = silver_trades(raw([(meta(T0), trade())]))
    assert tuple(df.columns) == SILVER_COLUMNS
    types = dict(df.dtypes)
    assert types["price"] == "decimal(38,18)" and types["trade_time"] == "timestamp_ntz"
    assert types["trade_date"] == "date" and types["trade_id"] == "bigint"


def test_gold_bar_values(spark, raw):
    rows = [(meta(T0 + i), trade(t=i, p=p, q=q, T=T0 + 60000 - 1000 + i * 500))
            for i, (p, q) in enumerate([("10", "1"), ("20", "2"), ("30", "0.5")])]
    bars = {r.minute_bucket: r for r in gold_trades_1m(silver_trades(raw(rows))).collect()}
    m0, m1 = dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 1)
    assert set(bars) == {m0, m1}           # a trade exactly on :01:00 starts the new bar
    b = bars[m1]
    assert b.trade_count == 1 and b.total_notional == Decimal("15") and b.avg_price == Decimal("30")
    a = bars[m0]
    assert a.trade_count == 2
    assert a.total_quantity == Decimal("3")
    assert a.total_notional == Decimal("50")
    assert a.avg_price == Decimal("15")
    assert (a.min_price, a.max_price) == (Decimal("10"), Decimal("20"))
    assert a.first_trade_time < a.last_trade_time


def test_later_copy_in_another_minute_moves_the_row(spark, raw):
    rows = [(meta(T0 + 1), trade(t=1, T=T0)), (meta(T0 + 2), trade(t=2, T=T0 + 10)),
            (meta(T0 + 86400000), trade(t=1, T=T0 + 86400000))]
    bars = gold_trades_1m(silver_trades(raw(rows))).orderBy("minute_bucket").collect()
    assert [(b.minute_bucket, b.trade_count) for b in bars] == [
        (dt.datetime(2024, 1, 1), 1), (dt.datetime(2024, 1, 2), 1)]


def test_avg_price_rounds_half_up_at_18(spark, raw):
    rows = [(meta(T0 + i), trade(t=i, p=p)) for i, p in enumerate(["1", "0", "0"])]
    [b] = gold_trades_1m(silver_trades(raw(rows))).collect()
    assert b.avg_price == Decimal("0.333333333333333333")
    rows = [(meta(T0 + i), trade(t=i, p=p)) for i, p in enumerate(["2", "0", "0"])]
    [b] = gold_trades_1m(silver_trades(raw(rows))).collect()
    assert b.avg_price == Decimal("0.666666666666666667")


def test_properties_on_fixture(spark):
    from barforge.plans.catalog import silver
    from conftest import SF_SMALL
    s = silver(spark, SF_SMALL)
    g = gold_trades_1m(s)
    tot = g.agg(F.sum("trade_count").alias("n"),
                F.count_if(~((F.col("min_price") <= F.col("avg_price"))
                             & (F.col("avg_price") <= F.col("max_price")))).alias("bad")).first()
    assert tot.n == s.count() == 971
    assert tot.bad == 0
    assert g.count() == 843


def test_cast_modes_hold_on_a_parquet_scan(spark, raw):
    import os

    import pytest

    from barforge.session import fresh_dir
    from barforge.sources.topic import read_bronze
    path = os.path.join(fresh_dir(spark, "scan"), "bronze")
    raw([(meta(T0), trade(t=1)), (meta(T0), trade(t="abc")), (meta(T0), trade(t="12", p="x"))]) \
        .write.parquet(path)
    b = read_bronze(spark, path)
    got = sorted((r.trade_id, r.price) for r in parse_trades(b, "permissive").collect()
                 if r.trade_id is not None)
    assert got == [(1, Decimal("1.5")), (12, None)]
    assert silver_trades(b, "permissive").count() == 1
    with pytest.raises(Exception):
        parse_trades(b, "strict").collect()


def test_dedup_is_idempotent_on_the_fixture(spark):
    from barforge.operators.silver import dedup_latest
    from barforge.plans.catalog import bronze
    from conftest import SF_SMALL
    b = bronze(spark, SF_SMALL)
    once = silver_trades(b)
    twice = silver_trades(b.unionByName(b))             # every row ties with its twin
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    again = dedup_latest(once.unionByName(once))
    assert again.count() == once.count() == 971
