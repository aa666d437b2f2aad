"""Bounded extremes: the few smallest and largest prices and trade times of a
stored bar, with how many trades hold each, so that a replaced trade can be
taken back without reading silver again.

Every extreme is kept as a list of its ``KEEP`` least values (largest ones are
negated, times are epoch milliseconds, so all four lists are alike).  ``whole``
says that the list holds all values of the bar; otherwise it is exact up to its
last value and says nothing beyond.  A batch brings lists of its net changes,
cut the same way.  Merging keeps what both lists know; a list with nothing left
while the bar still has trades is exhausted, and the bar is recomputed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.decimal import negated
from barforge.functions.timefn import epoch_ms_to_ntz, ntz_epoch_micros

#: Values a stored list and a batch's list of changes hold at most.
KEEP = 8
CHANGES = 16

BAR = ("symbol", "minute_bucket")
#: Extreme -> the column it is taken of, and whether the largest counts.
EXTREMES = {"min_price": ("price", False), "max_price": ("price", True),
            "first_trade_time": ("trade_time", False), "last_trade_time": ("trade_time", True)}
_ITEMS = "array<struct<v:decimal(38,18),n:bigint>>"
EDGE_DDL = f"struct<whole:boolean,items:{_ITEMS}>"
EDGES_DDL = "struct<" + ",".join(f"{name}:{EDGE_DDL}" for name in EXTREMES) + ">"


def _encode(name: str) -> Column:
    src, largest = EXTREMES[name]
    v = F.col(src) if src == "price" else F.floor(ntz_epoch_micros(F.col(src)) / 1000)
    if largest:
        v = negated(v) if src == "price" else -v
    return v.cast("decimal(38,18)")


def _decode(name: str, v: Column) -> Column:
    src, largest = EXTREMES[name]
    if src == "price":
        return (negated(v) if largest else v).cast("decimal(38,18)")
    return epoch_ms_to_ntz((-v if largest else v).cast("bigint"))


def edge_lists(rows: DataFrame, keep: int) -> DataFrame:
    """``symbol, minute_bucket, edges`` of rows (bar, price, trade_time, sign):
    per bar and extreme the ``keep`` least values whose signs do not cancel.
    Values are counted before they are ranked and ranks are cut before the
    exchange, so a hot bar ships at most ``keep`` + 1 values a partition."""
    each = rows.select(*BAR, "sign", F.inline(F.array(*[
        F.struct(F.lit(name).alias("extreme"), _encode(name).alias("v")) for name in EXTREMES])))
    net = each.groupBy(*BAR, "extreme", "v").agg(F.sum("sign").alias("n")).filter("n <> 0")
    rank = F.row_number().over(Window.partitionBy(*BAR, "extreme").orderBy("v"))
    least = net.withColumn("rank", rank).filter(F.col("rank") <= keep + 1)

    def edge(name: str) -> Column:
        own = F.col("extreme") == name
        items = F.array_sort(F.collect_list(F.when(own, F.struct("v", F.col("n").cast("bigint").alias("n")))))
        return F.struct((F.count(F.when(own, 1)) <= keep).alias("whole"), F.slice(items, 1, keep).alias("items")).alias(name)

    return least.groupBy(*BAR).agg(F.struct(*[edge(name) for name in EXTREMES]).cast(EDGES_DDL).alias("edges"))


def whole_and_empty() -> Column:
    """The lists of a bar without trades, and of a batch that changes no extreme."""
    none = F.struct(F.lit(True).alias("whole"), F.array().cast(_ITEMS).alias("items"))
    return F.struct(*[none.alias(name) for name in EXTREMES]).cast(EDGES_DDL)


def merged(stored: Column, changes: Column) -> Column:
    """Lists of a bar after the batch's changes.  Counts that are not positive
    stay in them as a mark (see :func:`contradicts`)."""

    def one(name: str) -> Column:
        old, new = stored[name], changes[name]

        def known(v: Column) -> Column:
            def by(e: Column) -> Column:
                return e["whole"] | F.coalesce(v <= F.array_max(F.transform(e["items"], lambda x: x["v"])), F.lit(False))
            return by(old) & by(new)

        def change(v: Column) -> Column:
            return F.coalesce(F.get(F.filter(new["items"], lambda x: x["v"] == v), F.lit(0))["n"], F.lit(0))

        both = F.concat(
            F.transform(old["items"], lambda x: F.struct(x["v"].alias("v"), (x["n"] + change(x["v"])).alias("n"))),
            F.filter(new["items"], lambda x: ~F.exists(old["items"], lambda y: y["v"] == x["v"])))
        items = F.array_sort(F.filter(both, lambda x: (x["n"] != 0) & known(x["v"])))
        return F.struct((old["whole"] & new["whole"] & (F.size(items) <= KEEP)).alias("whole"),
                        F.slice(items, 1, KEEP).alias("items")).alias(name)

    return F.struct(*[one(name) for name in EXTREMES]).cast(EDGES_DDL)


def extreme(edges: Column, name: str) -> Column:
    """The extreme itself, NULL where its list is empty."""
    return _decode(name, F.get(edges[name]["items"], F.lit(0))["v"])


def exhausted(edges: Column) -> Column:
    """Whether a list has nothing left."""
    return reduce(lambda a, b: a | b, [F.size(edges[name]["items"]) == 0 for name in EXTREMES])


def contradicts(edges: Column) -> Column:
    """Whether more trades left a value than the bar held."""
    return reduce(lambda a, b: a | b, [F.exists(edges[name]["items"], lambda x: x["n"] < 0) for name in EXTREMES])
