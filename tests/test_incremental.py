"""Any split of the raw layer into micro-batches, in any order,
must give exactly the batch silver and gold; replays change nothing."""

import os

from conftest import SF_SMALL, make_raw, meta, trade
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barforge.operators.gold import gold_trades_1m
from barforge.operators.silver import silver_trades
from barforge.session import fresh_dir
from barforge.sources import fixtures
from barforge.streaming import edges
from barforge.streaming import maintain as mt
from barforge.streaming import storage as stg


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def new_layout(spark, block=300):
    layout = stg.Layout(os.path.join(fresh_dir(spark, "inc"), "tables"), block)
    stg.bootstrap_layers(spark, layout)
    return layout


def events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


_expected = {}


def expected(spark):
    if not _expected:
        b = fixtures.bronze_from_events(events(spark))
        s = silver_trades(b)
        _expected["silver"], _expected["gold"] = rows(s), rows(gold_trades_1m(s))
    return _expected["silver"], _expected["gold"]


def apply_parts(spark, tagged, order, layout, tag="t"):
    for batch_id, p in enumerate(order):
        mt.upsert_batch(tagged.filter(F.col("part") == p).drop("part"), batch_id, layout, tag)


@settings(max_examples=3, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.integers(min_value=2, max_value=4), st.integers(min_value=0, max_value=1000), st.randoms())
def test_random_splits_equal_batch(spark, k, seed, rnd):
    m = fixtures.trade_messages(events(spark))
    tagged = m.select(F.parse_json("metadata").alias("record_metadata"),
                      F.parse_json("content").alias("record_content"),
                      F.pmod(F.xxhash64("content", F.lit(seed)), F.lit(k)).cast("int").alias("part"))
    order = list(range(k))
    rnd.shuffle(order)
    layout = new_layout(spark)
    apply_parts(spark, tagged, order, layout)
    s_exp, g_exp = expected(spark)
    assert rows(stg.read_silver(spark, layout)) == s_exp
    assert rows(stg.read_gold(spark, layout)) == g_exp


def test_stale_copies_last_and_replay(spark):
    tagged = fixtures.bronze_parts(events(spark), "redelivered_first")
    layout = new_layout(spark)
    apply_parts(spark, tagged, [0, 1, 2], layout)
    # replaying every batch (same ids) leaves both tables unchanged
    apply_parts(spark, tagged, [0, 1, 2], layout)
    # re-delivering all rows as a new batch changes nothing either
    mt.upsert_batch(tagged.drop("part"), 9, layout, "t")
    s_exp, g_exp = expected(spark)
    assert rows(stg.read_silver(spark, layout)) == s_exp
    assert rows(stg.read_gold(spark, layout)) == g_exp


def test_crash_after_silver_publish_is_repaired_by_replay(spark):
    tagged = fixtures.bronze_parts(events(spark), "copies")
    layout = new_layout(spark)
    mt.upsert_batch(tagged.filter("part = 0").drop("part"), 0, layout, "t")
    batch = tagged.filter("part = 1").drop("part")
    staged = mt.stage_silver(batch, 1, layout, "t")
    mt.publish_silver(spark, staged, layout, "t", 1)
    mt.publish_silver(spark, staged, layout, "t", 1)          # a retried publish is harmless
    # ... the job dies here, before gold; the stream re-runs batch 1
    mt.upsert_batch(batch, 1, layout, "t")
    mt.upsert_batch(tagged.filter("part = 2").drop("part"), 2, layout, "t")
    s_exp, g_exp = expected(spark)
    assert rows(stg.read_silver(spark, layout)) == s_exp
    assert rows(stg.read_gold(spark, layout)) == g_exp


def test_correction_moves_bar_to_another_day(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark)
    first = raw([(meta(t0 + 1), trade(t=1, T=t0)), (meta(t0 + 2), trade(t=2, s="ETHUSDT", T=t0))])
    mt.upsert_batch(first, 0, layout, "t")
    later = raw([(meta(t0 + 5), trade(t=1, T=t0 + 86400000, q="9"))])
    mt.upsert_batch(later, 1, layout, "t")
    bars = [(r.symbol, str(r.minute_bucket), r.trade_count)
            for r in stg.read_gold(spark, layout).orderBy("symbol", "minute_bucket").collect()]
    assert bars == [("BTCUSDT", "2024-01-02 00:00:00", 1), ("ETHUSDT", "2024-01-01 00:00:00", 1)]
    assert stg.read_silver(spark, layout).count() == 2


def test_streaming_query_equals_batch(spark):
    from barforge.plans.catalog import run_incremental
    layout, _, _ = run_incremental(spark, SF_SMALL, "hash", "stream_test", block_size=300)
    s_exp, g_exp = expected(spark)
    assert rows(stg.read_silver(spark, layout)) == s_exp
    assert rows(stg.read_gold(spark, layout)) == g_exp


def test_rebuild_equals_batch(spark):
    layout = new_layout(spark)
    mt.rebuild(fixtures.bronze_from_events(events(spark)), layout)
    s_exp, g_exp = expected(spark)
    assert rows(stg.read_silver(spark, layout)) == s_exp
    assert rows(stg.read_gold(spark, layout)) == g_exp


def test_rebuild_swaps_in_a_new_version(spark):
    layout = new_layout(spark)
    b = fixtures.bronze_from_events(events(spark))
    v1 = mt.rebuild(b, layout)
    v2 = mt.rebuild(b, layout)
    v3 = mt.rebuild(b, layout)
    kept = {d.rstrip("/").rsplit("/", 1)[-1] for d in stg.list_dirs(spark, layout.path("versions"))}
    assert len({v1, v2, v3}) == 3 and kept == {v2, v3} and stg.live(spark, layout).version == v3
    s_exp, g_exp = expected(spark)
    assert rows(stg.read_silver(spark, layout)) == s_exp
    assert rows(stg.read_gold(spark, layout)) == g_exp


def test_registered_tables_follow_the_files(spark):
    layout = new_layout(spark)
    stg.bootstrap_layers(spark, layout, register=True)
    mt.rebuild(fixtures.bronze_from_events(events(spark)), layout)
    assert spark.table("gold.trades_1m").count() == len(expected(spark)[1])
    assert spark.table("silver.trades_clean").count() == len(expected(spark)[0])
    stg.drop_tables(spark, layout)


def test_status_document_from_live_queries(spark):
    import json

    from barforge.operators import checks
    from barforge.streaming import lifecycle
    src = os.path.join(fresh_dir(spark, "status"), "in")
    spark.range(3).write.parquet(src)
    q = (spark.readStream.schema("id long").parquet(src).writeStream.format("noop")
         .queryName("status_probe").option("checkpointLocation", src + "_chk")
         .trigger(processingTime="1 second").start())
    try:
        doc = json.loads(lifecycle.status_document("p", [q]))
        assert doc["connector"]["state"] == "RUNNING" and doc["tasks"][0]["state"] == "RUNNING"
        r = checks.check_pipeline_status(lifecycle.status_from_queries(spark, "p", [q])).first()
        assert r.passed
    finally:
        assert lifecycle.stop_query(spark, "status_probe") is True
    doc = json.loads(lifecycle.status_document("p", [q]))
    assert doc["connector"]["state"] == "STOPPED"
    assert lifecycle.stop_query(spark, "no-such-query") is False


def test_block_size_is_fixed_per_layout(spark):
    import pytest
    layout = new_layout(spark, block=300)
    stg.bootstrap_layers(spark, layout)
    with pytest.raises(ValueError, match="id_block_size=300"):
        stg.bootstrap_layers(spark, stg.Layout(layout.root, 500))


@settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.tuples(st.integers(0, 5),               # trade id
                          st.sampled_from(["1", "2", "3", "2.5", "0.5"]),   # price
                          st.integers(0, 3),               # trade-time offset (minutes)
                          st.integers(0, 50)),             # ingest order
                min_size=6, max_size=14),
       st.integers(min_value=1, max_value=3))
def test_corrections_of_extremes_equal_batch(spark, events_rows, n_batches):
    """Later copies change price and minute, so replaced rows often held a
    bar's MIN/MAX/first/last: the recompute path must still give the rebuild."""
    t0 = 1704067200000
    rows = [(meta(t0 + ingest * 10 + i), trade(t=tid, p=p, T=t0 + off * 60000 + tid * 7))
            for i, (tid, p, off, ingest) in enumerate(events_rows)]
    layout = new_layout(spark, block=2)
    for b in range(n_batches):
        part = [r for i, r in enumerate(rows) if i % n_batches == b]
        if part:
            mt.upsert_batch(make_raw(spark, part), b, layout, "t")
    s = silver_trades(make_raw(spark, rows))
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(s)
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_lowered_maximum_is_recomputed_from_silver(spark, raw, monkeypatch):
    from decimal import Decimal
    t0 = 1704067200000
    seen = []
    monkeypatch.setattr(edges, "KEEP", 1)   # the list holds the lowered value alone
    original = mt._recompute

    def counting(spark_, layout_, stale):
        seen.append(stale.count())
        return original(spark_, layout_, stale)

    monkeypatch.setattr(mt, "_recompute", counting)
    layout = new_layout(spark)
    mt.upsert_batch(raw([(meta(t0 + i), trade(t=i, p=p, T=t0 + i)) for i, p in
                         enumerate(["1", "2", "3"])]), 0, layout, "t")
    mt.upsert_batch(raw([(meta(t0 + 99), trade(t=2, p="2.5", T=t0 + 2))]), 1, layout, "t")
    [bar] = stg.read_gold(spark, layout).collect()
    assert (bar.trade_count, bar.max_price, bar.min_price) == (3, Decimal("2.5"), Decimal("1"))
    assert bar.avg_price == Decimal("1.833333333333333333")
    assert seen == [1]      # batch 0 only adds trades: no recompute pass at all


def test_corrections_read_no_silver_while_the_lists_last(spark, raw, monkeypatch):
    """Lowered maxima, raised minima and moved times, one batch each: bars equal
    the rebuild and silver is read only once a list of ``KEEP`` is used up."""
    t0 = 1704067200000
    reads = []
    original = mt._recompute
    monkeypatch.setattr(mt, "_recompute", lambda s, lay, stale: reads.append(stale.count()) or original(s, lay, stale))
    monkeypatch.setattr(edges, "KEEP", 3)
    layout = new_layout(spark, block=4)
    everything = []

    def batch(n, trades):
        rows_ = [(meta(t0 + 100 * n + i), t) for i, t in enumerate(trades)]
        everything.extend(rows_)
        mt.upsert_batch(raw(rows_), n, layout, "t")

    def equals_batch():
        return rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(silver_trades(raw(everything))))

    batch(0, [trade(t=i, p=str(10 + i), T=t0 + 1000 * i) for i in range(10)])
    # The largest price and last time go, the smallest and first to another minute.
    batch(1, [trade(t=9, p="15.5", T=t0 + 5500), trade(t=0, p="15.25", T=t0 + 60000)])
    assert reads == [] and equals_batch()
    batch(2, [trade(t=i, p="15.5", T=t0 + 5500) for i in (7, 8)])    # the list of the largest is used up
    assert reads == [1] and equals_batch()
    batch(3, [trade(t=1, p="15.5", T=t0 + 5500)])            # the recomputed bar has lists again
    assert reads == [1] and equals_batch()


def test_inconsistent_gold_is_repaired_from_silver(spark, raw):
    """If a stored bar was lost (e.g. deleted by hand), the next batch that
    touches it rebuilds it from silver instead of producing a negative count."""
    t0 = 1704067200000
    layout = new_layout(spark)
    mt.upsert_batch(raw([(meta(t0 + i), trade(t=i, T=t0 + i)) for i in range(3)]), 0, layout, "t")
    stg.delete(spark, stg.live(spark, layout).gold + "/minute_date=2024-01-01")
    mt.upsert_batch(raw([(meta(t0 + 99), trade(t=1, T=t0 + 1, q="7"))]), 1, layout, "t")
    s = silver_trades(raw([(meta(t0 + i), trade(t=i, T=t0 + i)) for i in range(3)]
                          + [(meta(t0 + 99), trade(t=1, T=t0 + 1, q="7"))]))
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))


def test_symbols_that_need_escaping_keep_their_rows(spark, raw):
    """Partition folders of such symbols are escaped by Spark (e.g. '/' -> %2F);
    the touched-partition reader must find them, or a block would be lost."""
    t0 = 1704067200000
    layout = new_layout(spark)
    odd = ["BTC/USDT", "ETH=USD", "A%B", "sp ace", "Q?#", "", " ", "ж", "x" * 300, "__HIVE_DEFAULT_PARTITION__", "."]
    first = [(meta(t0 + i), trade(t=i + k, s=sym, T=t0 + i))
             for i, sym in enumerate(odd) for k in (0, 100)]      # two trades per block
    mt.upsert_batch(raw(first), 0, layout, "t")
    later = [(meta(t0 + 50 + i), trade(t=i, s=sym, T=t0 + 60000 + i, q="5"))
             for i, sym in enumerate(odd)]
    mt.upsert_batch(raw(later), 1, layout, "t")
    s = silver_trades(raw(first + later))
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(s)
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))


def test_existing_partitions_finds_escaped_folders(spark):
    import datetime as dt
    root = os.path.join(fresh_dir(spark, "parts"), "t")
    odd = ["BTC/USDT", "ETH=USD", "A%B", "sp ace", "Q?#", "plain"]
    day = dt.date(2024, 1, 1)
    spark.createDataFrame([(day, s, 1) for s in odd], "minute_date date, symbol string, v int") \
        .write.partitionBy("minute_date", "symbol").parquet(root)
    wanted = [(day, s) for s in odd] + [(day, "missing"), (dt.date(2024, 1, 2), "plain")]
    found = stg.existing_partitions(spark, root, ("minute_date", "symbol"), wanted)
    assert len(found) == len(odd)
    got = spark.read.option("basePath", root).parquet(*found)
    assert sorted(r.symbol for r in got.collect()) == sorted(odd)
    assert stg.existing_partitions(spark, root, ("minute_date",), [(day,)]) == \
        [stg.partition_path(root, ("minute_date",), (day,))]


def test_registered_tables_learn_partitions_per_batch(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark)
    stg.bootstrap_layers(spark, layout, register=True)
    try:
        mt.upsert_batch(raw([(meta(t0), trade(t=1, s="BTC/USDT", T=t0))]), 0, layout, "t")
        assert spark.table("gold.trades_1m").count() == 1
        assert spark.table("silver.trades_clean").count() == 1
        # the only bar moves to another day: its old partition is dropped
        mt.upsert_batch(raw([(meta(t0 + 9), trade(t=1, s="BTC/USDT", T=t0 + 86400000))]), 1,
                        layout, "t")
        got = [(str(r.minute_date), r.symbol) for r in
               spark.table("gold.trades_1m").select("minute_date", "symbol").collect()]
        assert got == [("2024-01-02", "BTC/USDT")]
        parts = [r[0] for r in spark.sql("SHOW PARTITIONS gold.trades_1m").collect()]
        assert len(parts) == 1 and parts[0].startswith("minute_date=2024-01-02")
    finally:
        stg.drop_tables(spark, layout)


def _block_files(spark, layout, symbol, block):
    return sorted(os.path.basename(f) for f in stg.list_files(
        spark, stg.partition_path(layout.silver, stg.SILVER_PARTS, ("s_" + symbol, block))))


def test_new_trades_are_appended_without_rewriting_the_block(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark, block=1000)
    mt.upsert_batch(raw([(meta(t0 + i), trade(t=i, T=t0 + i)) for i in range(5)]), 0, layout, "t")
    before = _block_files(spark, layout, "BTCUSDT", 0)
    mt.upsert_batch(raw([(meta(t0 + 10), trade(t=7, T=t0 + 10))]), 1, layout, "t")
    after = _block_files(spark, layout, "BTCUSDT", 0)
    assert set(before) < set(after) and len(after) == len(before) + 1      # old files untouched
    # a replaced row forces a rewrite of its block into a single file
    mt.upsert_batch(raw([(meta(t0 + 20), trade(t=7, T=t0 + 10, q="9"))]), 2, layout, "t")
    assert len(_block_files(spark, layout, "BTCUSDT", 0)) == 1
    rows = [(meta(t0 + i), trade(t=i, T=t0 + i)) for i in range(5)] + \
        [(meta(t0 + 10), trade(t=7, T=t0 + 10)), (meta(t0 + 20), trade(t=7, T=t0 + 10, q="9"))]
    s = silver_trades(raw(rows))
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(s)
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))


def test_compaction_merges_appended_files(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark, block=1000)
    rows = []
    for b in range(4):
        part = [(meta(t0 + b), trade(t=b, T=t0 + b * 1000))]
        rows += part
        mt.upsert_batch(raw(part), b, layout, "t")
    assert len(_block_files(spark, layout, "BTCUSDT", 0)) == 4
    assert (mt.compact(spark, layout), mt.compact(spark, layout)) == (1, 0)
    assert len(_block_files(spark, layout, "BTCUSDT", 0)) == 1
    s = silver_trades(raw(rows))
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(s)
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))


def test_crash_after_moving_one_of_several_files_of_a_block(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark, block=1000)
    rows = [(meta(t0 + i), trade(t=i, T=t0 + i)) for i in range(10)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 4)
    try:
        staged = mt.stage_silver(raw(rows), 0, stg.live(spark, layout), "t")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    part = stg.staged_partitions(spark, staged.append)[0]
    files = sorted(stg.list_files(spark, stg.partition_path(staged.append, stg.SILVER_PARTS, part)))
    assert len(files) == 3
    stg.rename(spark, files[0], stg.partition_path(layout.silver, stg.SILVER_PARTS, part)
               + f"/t-{0:012d}-{files[0].rsplit('/', 1)[-1]}")
    mt.upsert_batch(raw(rows), 0, layout, "t")                 # the stream re-runs batch 0
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(silver_trades(raw(rows)))


def test_a_stage_of_an_older_version_is_not_applied(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark, block=1000)
    rows = [(meta(t0 + i), trade(t=i, T=t0 + i)) for i in range(10)]
    mt.stage_silver(raw(rows), 0, stg.live(spark, layout), "t")   # ... the job dies here
    mt.rebuild(raw(rows), layout)
    mt.upsert_batch(raw(rows), 0, layout, "t")                 # the stream re-runs batch 0
    s = silver_trades(raw(rows))
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(s)
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))


def test_crash_before_the_pointer_leaves_both_tables(spark, raw, monkeypatch):
    import pytest
    t0 = 1704067200000
    layout = new_layout(spark, block=1000)
    rows = [(meta(t0 + i), trade(t=i, T=t0 + i)) for i in range(4)]
    mt.upsert_batch(raw(rows[:2]), 0, layout, "t")
    before = rows_of(stg.read_silver(spark, layout)), rows_of(stg.read_gold(spark, layout))

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(stg, "point_to", crash)
        with pytest.raises(RuntimeError, match="crash"):
            mt.rebuild(raw(rows), layout)
    assert (rows_of(stg.read_silver(spark, layout)), rows_of(stg.read_gold(spark, layout))) == before
    mt.rebuild(raw(rows), layout)
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(silver_trades(raw(rows)))


def test_large_prices_are_exact_in_both_paths(spark, raw):
    from decimal import Decimal
    t0 = 1704067200000
    layout = new_layout(spark)
    rows = [(meta(t0 + i), trade(t=i, p=p, q=q, T=t0 + i * 60000)) for i, (p, q) in enumerate([
        ("12345678901234567890", "0.5"), ("1" + "0" * 17, "2"), ("1" + "0" * 19, "9.999999999999999999"),
        ("99999999999999999999.999999999999999999", "3"), ("0.000000000000000001", "0.5")])]
    for i, r in enumerate(rows):
        mt.upsert_batch(raw([r]), i, layout, "t")
    s = silver_trades(raw(rows))
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))
    totals = [r.total_notional for r in gold_trades_1m(s).orderBy("minute_bucket").collect()]
    assert totals == [Decimal("6172839450617283945"), Decimal("2" + "0" * 17), Decimal("99999999999999999990"),
                      None, Decimal("0.000000000000000001")]


def test_bad_ids_do_not_stop_a_rebuild_and_are_listed(spark, raw):
    from barforge.operators.silver import cast_rejects
    t0 = 1704067200000
    layout = new_layout(spark)
    rows = [(meta(t0), trade(t="abc", T=t0)), (meta(t0), trade(t=2, T=t0, b="x", m="maybe")), (meta(t0), trade(t="7", T=t0))]
    mt.upsert_batch(raw(rows), 0, layout, "t")
    maintained = rows_of(stg.read_silver(spark, layout))
    mt.rebuild(raw(rows), layout)
    assert rows_of(stg.read_silver(spark, layout)) == maintained and len(maintained) == 2
    assert sorted((r.field, r.value) for r in cast_rejects(raw(rows)).collect()) == [("b", "x"), ("m", "maybe"), ("t", "abc")]


def test_crash_midway_through_appends_is_repaired(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark, block=1000)
    first = [(meta(t0 + i), trade(t=i, s=sym, T=t0 + i)) for i, sym in
             enumerate(["BTCUSDT", "ETHUSDT", "SOLUSDT"])]
    mt.upsert_batch(raw(first), 0, layout, "t")
    more = [(meta(t0 + 10 + i), trade(t=10 + i, s=sym, T=t0 + 10 + i)) for i, sym in
            enumerate(["BTCUSDT", "ETHUSDT", "SOLUSDT"])]
    staged = mt.stage_silver(raw(more), 1, stg.live(spark, layout), "t")
    # the first appended file reaches its block, then the job dies
    sym, blk = stg.staged_partitions(spark, staged.append)[0]
    src = stg.list_files(spark, stg.partition_path(staged.append, stg.SILVER_PARTS, (sym, blk)))[0]
    stg.rename(spark, src, stg.partition_path(layout.silver, stg.SILVER_PARTS, (sym, blk))
               + f"/t-000000000001-{src.rsplit('/', 1)[-1]}")
    mt.upsert_batch(raw(more), 1, layout, "t")                 # the stream re-runs batch 1
    s = silver_trades(raw(first + more))
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(s)
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))


def test_plans_do_not_grow_with_touched_blocks(spark, raw):
    t0 = 1704067200000
    layout = new_layout(spark, block=1)
    rows = [(meta(t0 + i), trade(t=i, T=t0)) for i in range(150)]
    mt.upsert_batch(raw(rows), 0, layout, "t")
    later = [(meta(t0 + 1000 + i), trade(t=i, T=t0, q="7")) for i in range(0, 150, 3)]
    mt.upsert_batch(raw(later), 1, layout, "t")
    s = silver_trades(raw(rows + later))
    assert rows_of(stg.read_silver(spark, layout)) == rows_of(s)
    assert rows_of(stg.read_gold(spark, layout)) == rows_of(gold_trades_1m(s))
    blocks = [("s_BTCUSDT", i) for i in range(2000)]
    plan = spark.range(9).selectExpr("'s_BTCUSDT' AS symbol_key", "id AS id_block").join(
        stg.partition_rows(spark, stg.SILVER_PARTS, blocks, mt.SILVER_PART_DDL), list(stg.SILVER_PARTS), "left_semi")
    assert plan.count() == 9 and len(plan._jdf.queryExecution().executedPlan().toString()) < 20_000


def test_the_stream_hands_typed_rows_to_its_batches(spark, raw, monkeypatch):
    """A batch has no scan to push VARIANT paths into: the parse precedes it."""
    root = stg.os.path.join(fresh_dir(spark, "typedbatch"), "t")
    raw([(meta(5), trade(t=1)), (meta(6), trade(t=2, T="bad"))]).write.parquet(root + "/raw")
    seen = []
    monkeypatch.setattr(mt, "upsert_batch", lambda batch, *_: seen.append((dict(batch.dtypes), batch.count())))
    stream = spark.readStream.schema("record_metadata variant, record_content variant").parquet(root + "/raw")
    mt.maintain(stream, stg.Layout(root + "/tables"), root + "/chk", trigger={"availableNow": True}).awaitTermination()
    assert seen and "variant" not in seen[0][0].values() and seen[0][0]["raw_time"] == "timestamp_ntz" and seen[0][1] == 2
