"""Lists behind a bar's extremes: after any changes they are a true prefix of
the bar's values with counts, or empty."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from barforge.streaming import edges as eg

MINUTE = dt.datetime(2024, 1, 1)
DDL = "symbol string, minute_bucket timestamp_ntz, price decimal(38,18), trade_time timestamp_ntz, sign int"


def trades(symbol, values, sign):
    return [(symbol, MINUTE, Decimal(p), MINUTE + dt.timedelta(milliseconds=t), sign) for p, t in values]


def test_merged_lists_are_true_prefixes(spark, monkeypatch):
    monkeypatch.setattr(eg, "KEEP", 3)
    rng = random.Random(7)
    draw = lambda n: [(rng.randint(1, 12), rng.randint(0, 9)) for _ in range(n)]
    before, changes, after = [], [], {}
    for i in range(400):
        held = draw(rng.randint(0, 25))
        gone, new = rng.sample(held, rng.randint(0, min(len(held), 8))), draw(rng.randint(0, 8))
        before += trades(f"s{i}", held, 1)
        changes += trades(f"s{i}", gone, -1) + trades(f"s{i}", new, 1)
        after[f"s{i}"] = list((Counter(held) - Counter(gone) + Counter(new)).elements())
    bars = spark.createDataFrame([(s, MINUTE) for s in after], "symbol string, minute_bucket timestamp_ntz")
    old = eg.edge_lists(spark.createDataFrame(before, DDL), 3).withColumnRenamed("edges", "old")
    new = eg.edge_lists(spark.createDataFrame(changes, DDL), 5).withColumnRenamed("edges", "new")
    got = bars.join(old, list(eg.BAR), "left").join(new, list(eg.BAR), "left").select(
        "symbol", eg.merged(F.coalesce("old", eg.whole_and_empty()), F.coalesce("new", eg.whole_and_empty())).alias("edges"))
    rows = got.select("*", eg.contradicts(F.col("edges")).alias("bad"), *[eg.extreme(F.col("edges"), n).alias(n) for n in eg.EXTREMES]).collect()
    used_up = 0
    for r in rows:
        assert not r.bad
        for name, (src, largest) in eg.EXTREMES.items():
            values = [p if src == "price" else 1704067200000 + t for p, t in after[r.symbol]]
            truth = sorted(Counter(-v if largest else v for v in values).items())
            edge = r.edges[name]
            items = [(int(x.v), x.n) for x in edge["items"]]
            assert items == truth[:len(items)] and len(items) <= 3
            assert not edge["whole"] or items == truth
            used_up += bool(truth) and not items
            if items:
                best = max(values) if largest else min(values)
                assert r[name] == (Decimal(best) if src == "price" else MINUTE + dt.timedelta(milliseconds=best - 1704067200000))
    assert len(rows) == 400 and 0 < used_up < 400


def test_more_removed_than_held_is_noticed(spark):
    old = eg.edge_lists(spark.createDataFrame(trades("a", [(1, 1)], 1), DDL), 3).withColumnRenamed("edges", "old")
    new = eg.edge_lists(spark.createDataFrame(trades("a", [(1, 1), (1, 1)], -1), DDL), 5).withColumnRenamed("edges", "new")
    assert old.join(new, list(eg.BAR)).select(eg.contradicts(eg.merged(F.col("old"), F.col("new")))).first()[0]
