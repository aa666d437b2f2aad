"""Raw payloads -> typed, validated, keep-latest trades (silver).

Plan shape: scan -> one projection of variant reads -> validity filter ->
hash exchange on (symbol, trade_id) -> WindowGroupLimit/rank filter.  The
row-number filter lets Catalyst add a partial ``WindowGroupLimit`` before
the exchange, so duplicate copies are pruned map-side and a key with many
copies ships at most one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.jsonpath import (json_bigint, json_boolean, json_string,
                                         json_time_ntz, try_to_decimal)
from barforge.functions.timefn import day_bucket

KEY = ("symbol", "trade_id")
REQUIRED = ("symbol", "trade_id", "trade_time", "price", "quantity")
PARSED_COLUMNS = ("event_type", "event_time", "symbol", "trade_id", "price", "quantity",
                  "buyer_order_id", "seller_order_id", "trade_time", "is_maker", "ingested_at")
SILVER_COLUMNS = PARSED_COLUMNS + ("trade_date",)
# Metadata spellings of the record create time, in the order they are tried.
CREATE_TIME_KEYS = ("CreateTime", "createTime", "CREATETIME")


def latest_first() -> list[Column]:
    """Total order used to pick the surviving copy of a key.

    Latest ingest wins (the reference's rule); ties -- left open by the
    reference -- fall to the later event time and then to the row contents,
    so every engine and every arrival order pick the same row.
    """
    return [F.col("ingested_at").desc_nulls_last(), F.col("event_time").desc_nulls_last(),
            F.col("trade_time").desc_nulls_last(), F.col("quantity").desc_nulls_last(),
            F.col("price").desc_nulls_last(), F.col("event_type").desc_nulls_last(),
            F.col("buyer_order_id").desc_nulls_last(), F.col("seller_order_id").desc_nulls_last(),
            F.col("is_maker").desc_nulls_last()]


def parse_trades(bronze: DataFrame, mode: str = "strict",
                 content: str = "record_content", metadata: str = "record_metadata",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection of the raw layer (F1-F8), 11 columns, and those of
    ``bronze`` named in ``keep``.

    ``mode='strict'`` fails on a non-numeric trade/order id or a non-boolean
    maker flag, as the reference does; ``'permissive'`` turns them into NULL
    (a row without a trade id then drops out of :func:`valid_trades`), and
    :func:`cast_rejects` lists them.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be strict or permissive, not {mode!r}")
    strict = mode == "strict"
    c, m = F.col(content), F.col(metadata)
    typed = bronze.select(
        json_string(c, "e", strict).alias("event_type"),
        json_time_ntz(c, "E").alias("event_time"),
        json_string(c, "s", strict).alias("symbol"),
        json_bigint(c, "t", strict).alias("trade_id"),
        try_to_decimal(json_string(c, "p", False)).alias("price"),
        try_to_decimal(json_string(c, "q", False)).alias("quantity"),
        json_bigint(c, "b", strict).alias("buyer_order_id"),
        json_bigint(c, "a", strict).alias("seller_order_id"),
        json_time_ntz(c, "T").alias("trade_time"),
        json_boolean(c, "m", strict).alias("is_maker"),
        *[json_time_ntz(m, k).alias(f"_meta_{i}") for i, k in enumerate(CREATE_TIME_KEYS)],
        *keep,
    )
    # F8: first non-null of the three metadata spellings, then E, then T.
    return typed.select(
        *PARSED_COLUMNS[:-1],
        F.coalesce(*[F.col(f"_meta_{i}") for i in range(len(CREATE_TIME_KEYS))],
                   F.col("event_time"), F.col("trade_time")).alias("ingested_at"),
        *keep,
    )


def rejected_fields(content: str = "record_content") -> Column:
    """the fields of a payload that permissive parsing turns into NULL
    although it holds a value, as an array of (field, value, reason)."""
    c = F.col(content)
    fields = [("t", json_bigint(c, "t", False), "not a number"),
              ("b", json_bigint(c, "b", False), "not a number"),
              ("a", json_bigint(c, "a", False), "not a number"),
              ("m", json_boolean(c, "m", False), "not a flag")]
    found = F.array(*[
        F.when(typed.isNull() & json_string(c, key, False).isNotNull(),
               F.struct(F.lit(key).alias("field"), json_string(c, key, False).alias("value"),
                        F.lit(reason).alias("reason")))
        for key, typed, reason in fields])
    return F.filter(found, lambda x: x.isNotNull())


def cast_rejects(bronze: DataFrame, keep: tuple[str, ...] = (),
                 content: str = "record_content") -> DataFrame:
    """F2/F3 quarantine: one row per rejected field -- the ``keep`` columns,
    the field's name, its text and a reason."""
    return bronze.select(*keep, F.inline(rejected_fields(content)))


def valid_trades(parsed: DataFrame) -> DataFrame:
    """R2: keep rows whose five required fields are all present."""
    cond = None
    for name in REQUIRED:
        term = F.col(name).isNotNull()
        cond = term if cond is None else cond & term
    return parsed.filter(cond)


def dedup_latest(df: DataFrame, keys=KEY, order: list[Column] | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``."""
    w = Window.partitionBy(*keys).orderBy(*(order or latest_first()))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def silver_projection(df: DataFrame) -> DataFrame:
    """The 11 typed columns plus the ``trade_date`` pruning helper."""
    return df.select(*PARSED_COLUMNS, day_bucket(F.col("trade_time")).alias("trade_date"))


def silver_trades(bronze: DataFrame, mode: str = "strict") -> DataFrame:
    """R1 -> R2 -> R3 -> R4: the silver table as a function of all raw rows."""
    return silver_projection(dedup_latest(valid_trades(parse_trades(bronze, mode))))
