"""A1-A4: exact one-minute trade bars per symbol (gold).

Plan shape: partial HashAggregate -> exchange on (symbol, minute_bucket) ->
final HashAggregate.  A hot symbol is spread over its minutes, and a hot
minute is pre-combined map-side, so no task receives more than one partial
row per (group, input partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.functions.decimal import limb_total, with_limbs
from barforge.functions.timefn import minute_bucket

GOLD_KEY = ("symbol", "minute_bucket")
GOLD_COLUMNS = ("symbol", "minute_bucket", "trade_count", "total_quantity", "total_notional",
                "avg_price", "min_price", "max_price", "first_trade_time", "last_trade_time")


def bar_aggregates():
    """The bar measures, in output order (COUNT/SUM/AVG/MIN/MAX only), over
    rows that carry their product's limbs (``with_limbs``)."""
    n = F.count(F.lit(1))
    return [
        n.alias("trade_count"),
        F.try_sum("quantity").alias("total_quantity"),
        limb_total().alias("total_notional"),
        # Unweighted mean of price as exact sum / count: avg() has room for
        # sixteen integer digits only.
        (F.try_sum("price") / n).cast("decimal(38,18)").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.min("trade_time").alias("first_trade_time"),
        F.max("trade_time").alias("last_trade_time"),
    ]


def with_minute(silver: DataFrame) -> DataFrame:
    """The columns bars are made of, with the minute and the product's limbs."""
    return with_limbs(silver.select("symbol", minute_bucket(F.col("trade_time")).alias("minute_bucket"),
                                    "price", "quantity", "trade_time"))


def gold_trades_1m(silver: DataFrame) -> DataFrame:
    """A1: group silver by (symbol, minute) -- no empty-minute fill, no open/close."""
    return with_minute(silver).groupBy(*GOLD_KEY).agg(*bar_aggregates())
