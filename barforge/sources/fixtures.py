"""Deterministic inputs derived from the driver's tables.

The reference ships no data, so its inputs are rebuilt from the given
parquet tables with Spark (their size grows with the tables):

* ``events``   -> exchange trade messages, topic rows and the raw layer;
* ``orders``   -> warehouse metering history (usage guardrail input);
* ``supplier`` -> pipeline status documents (status check input).

Each rule below has a twin in ``barforge.plans.oracle`` written for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.functions.jsonpath import json_time_ntz
from barforge.functions.once import evaluate_once
from barforge.functions.timefn import ntz_epoch_micros

# Fixed values of the derived trade fixture: topic name, time origin
# (2024-01-01 00:00:00 UTC in ms), time compression factor, symbol per event
# type (anything else is XRPUSDT) and the delivery shift of each copy
# (0 original, 1 redelivered later, 2 stale).
TOPIC = "crypto_trades"
BASE_MS = 1704067200000
COMPRESSION = 60
SYMBOL_BY_EVENT_TYPE = {
    "click": "BTCUSDT",
    "view": "ETHUSDT",
    "purchase": "SOLUSDT",
    "signup": "BNBUSDT",
}
OTHER_SYMBOL = "XRPUSDT"
COPY_SHIFT_MS = {0: 0, 1: 5000, 2: -1000}


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows over the cluster's cores by key, always: building and
    parsing JSON downstream then runs in parallel however the input is filed."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _symbol_case() -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SYMBOL_BY_EVENT_TYPE.items())
    return f"CASE event_type {arms} ELSE '{OTHER_SYMBOL}' END"


def trade_messages(events: DataFrame) -> DataFrame:
    """One row per delivered copy of a trade message.

    Columns: ``id, copy, symbol, e_ms, create_ms, meta_key, content``
    (payload JSON text), ``metadata`` (record metadata JSON text),
    ``message`` (what arrives on the wire: sometimes wrapped as
    ``{"data": ...}``, sometimes broken) and ``offset``.
    """
    shift = ("CASE copy " + " ".join(f"WHEN {k} THEN {v}" for k, v in COPY_SHIFT_MS.items())
             + " END")
    base = spread(events, "event_id").select(
        F.col("event_id").alias("id"), "user_id", "event_type", "value",
        ntz_epoch_micros(F.col("ts")).alias("us"))
    copies = base.selectExpr(
        "*", "explode(filter(array(0, 1, 2), c -> c = 0 OR (c = 1 AND id % 10 = 0)"
             " OR (c = 2 AND id % 50 = 0))) AS copy")
    step = copies.selectExpr(
        "id", "user_id", "copy",
        f"{BASE_MS} + ((us div 1000) - {BASE_MS}) div {COMPRESSION} AS tt",
        f"{shift} AS shift",
        "CASE WHEN id % 107 = 0 THEN NULL WHEN id % 109 = 0 THEN 'createTime'"
        " WHEN id % 113 = 0 THEN 'CREATETIME' ELSE 'CreateTime' END AS meta_key",
        f"CASE WHEN id % 101 = 0 THEN NULL ELSE {_symbol_case()} END AS symbol",
        "CAST(round(value * 100) AS BIGINT) AS cents",
    ).selectExpr(
        "*",
        "tt + 5 + id % 20 + CASE WHEN meta_key IS NULL THEN shift ELSE 0 END AS e_ms",
    ).selectExpr(
        "*",
        "CASE WHEN meta_key IS NOT NULL THEN e_ms + 50 + shift END AS create_ms",
        "CASE WHEN id % 97 = 0 THEN 'N/A' ELSE concat(CAST(cents div 100 AS STRING), '.',"
        " lpad(CAST(cents % 100 AS STRING), 2, '0'),"
        " lpad(CAST(id % 1000000 AS STRING), 6, '0')) END AS price_text",
        "concat(CAST(user_id % 10 + copy AS STRING), '.',"
        " lpad(CAST(id * 7919 % 100000000 AS STRING), 8, '0')) AS qty_text",
        "id * 3 + copy AS offset",
    )
    content = (
        "concat('{\"e\":\"trade\",\"E\":', CAST(e_ms AS STRING),"
        " CASE WHEN symbol IS NULL THEN '' ELSE concat(',\"s\":\"', symbol, '\"') END,"
        " ',\"t\":', CAST(id AS STRING),"
        " ',\"p\":\"', price_text, '\",\"q\":\"', qty_text, '\"',"
        " ',\"b\":', CAST(1000000 + id AS STRING), ',\"a\":', CAST(2000000 + id AS STRING),"
        " ',\"T\":', CASE WHEN id % 103 = 0 THEN '\"bad\"' ELSE CAST(tt AS STRING) END,"
        " ',\"m\":', CASE WHEN id % 2 = 0 THEN 'true' ELSE 'false' END, '}')"
    )
    metadata = (
        "concat('{', CASE WHEN meta_key IS NULL THEN ''"
        " ELSE concat('\"', meta_key, '\":', CAST(create_ms AS STRING), ',') END,"
        f" '\"topic\":\"{TOPIC}\",\"partition\":0,\"offset\":', CAST(offset AS STRING), '}}')"
    )
    return step.selectExpr(
        "id", "copy", "tt", "symbol", "e_ms", "create_ms", "meta_key", "offset",
        f"{content} AS content", f"{metadata} AS metadata",
    ).selectExpr(
        "*",
        "CASE WHEN id % 211 = 0 THEN '{bad' WHEN id % 3 = 0"
        " THEN concat('{\"data\":', content, '}') ELSE content END AS message",
    )


def bronze_from_events(events: DataFrame) -> DataFrame:
    """The raw layer as the sink would have written it:
    ``record_metadata VARIANT, record_content VARIANT``."""
    m = trade_messages(events)
    return with_trade_time(evaluate_once(m, F.parse_json("metadata").alias("record_metadata"),
                                         F.parse_json("content").alias("record_content"), keep=False))


def with_trade_time(raw: DataFrame) -> DataFrame:
    """The raw layer's typed trade time, next to the payload."""
    return raw.withColumn("trade_time", json_time_ntz("record_content", "T"))


def _with_bad_fields(m: DataFrame, column: str) -> DataFrame:
    """``c3``: the JSON text of ``column`` where some payloads hold a trade id,
    an order id or a maker flag of the wrong type."""
    return m.selectExpr(
        "*", f"CASE WHEN id % 89 = 0 THEN replace({column}, concat('\"t\":', id, ','), '\"t\":\"abc\",') ELSE {column} END AS c1",
    ).selectExpr(
        "*", "CASE WHEN id % 83 = 0 THEN replace(c1, '\"m\":', '\"m\":\"maybe\",\"x\":') ELSE c1 END AS c2",
    ).selectExpr(
        "*", "CASE WHEN id % 79 = 0 THEN replace(c2, '\"b\":', '\"b\":\"none\",\"y\":') ELSE c2 END AS c3")


def bronze_with_bad_fields(events: DataFrame) -> DataFrame:
    """Raw rows (``offset``, metadata, payload), some with bad fields."""
    m = _with_bad_fields(trade_messages(events).select("offset", "metadata", "id", "content"), "content")
    return evaluate_once(m, F.col("offset"), F.parse_json("metadata").alias("record_metadata"),
                         F.parse_json("c3").alias("record_content"), keep=False)


def topic_with_bad_fields(events: DataFrame) -> DataFrame:
    """Wire messages (see :func:`topic_rows`), some with bad fields."""
    return topic_rows(events, lambda m: _with_bad_fields(m, "message").drop("message").withColumnRenamed("c3", "message"))


def topic_rows(events: DataFrame, alter: Callable[[DataFrame], DataFrame] = lambda m: m) -> DataFrame:
    """Wire messages as a topic would carry them:
    ``key, value, topic, partition, offset, timestamp`` (the Kafka source schema)."""
    m = alter(trade_messages(events))
    return m.select(
        F.col("symbol").alias("key"),
        F.col("message").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.timestamp_millis(F.coalesce("create_ms", "e_ms")).alias("timestamp"),
    )


def metering_from_orders(orders: DataFrame) -> DataFrame:
    """Warehouse metering history: ``warehouse_name, start_time, credits_used``."""
    return spread(orders, "o_orderkey").selectExpr(
        "concat('WH_', CAST(o_custkey % 4 AS STRING)) AS warehouse_name",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS start_time",
        "CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(20,2)) / 1000000"
        " AS DECIMAL(20,6)) AS credits_used",
    )


def status_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Pipeline status documents (``doc_id``, ``status_json`` text), one per
    supplier: failed connector if key % 7 = 0, no task list if % 11 = 0,
    empty task list if % 5 = 0, a paused second task if % 3 = 0."""
    return supplier.selectExpr(
        "s_suppkey AS doc_id",
        "concat('{\"name\":\"trades-sink\",\"connector\":{\"state\":\"',"
        " CASE WHEN s_suppkey % 7 = 0 THEN 'FAILED' ELSE 'RUNNING' END, '\"}',"
        " CASE WHEN s_suppkey % 11 = 0 THEN ''"
        " WHEN s_suppkey % 5 = 0 THEN ',\"tasks\":[]'"
        " WHEN s_suppkey % 3 = 0 THEN ',\"tasks\":[{\"id\":0,\"state\":\"RUNNING\"},"
        "{\"id\":1,\"state\":\"PAUSED\"}]'"
        " ELSE ',\"tasks\":[{\"id\":0,\"state\":\"RUNNING\"}]' END, '}') AS status_json",
    )


# Micro-batch arrival orders used to exercise incremental maintenance.
SPLITS = ("hash", "copies", "redelivered_first", "time_then_copies", "whole")
STREAM_CHUNK_MS = 3 * 3600 * 1000


def bronze_parts(events: DataFrame, split: str = "hash", parts: int = 4) -> DataFrame:
    """Raw-layer rows tagged with the micro-batch (``part``) they arrive in.

    * ``hash``: ``pmod(xxhash64(content), parts)`` -- copies interleaved;
    * ``copies``: originals, then redeliveries, then stale copies;
    * ``redelivered_first``: redeliveries, then originals, stale copies last;
    * ``time_then_copies``: originals in four trade-time chunks, then
      redeliveries, then stale copies (the in-order feed of the
      watermark-bounded variant);
    * ``whole``: one batch.
    """
    m = trade_messages(events)
    if split == "hash":
        part = F.pmod(F.xxhash64("content"), F.lit(parts))
    elif split == "copies":
        part = F.col("copy")
    elif split == "redelivered_first":
        part = F.when(F.col("copy") == 1, 0).when(F.col("copy") == 0, 1).otherwise(2)
    elif split == "time_then_copies":
        chunk = (F.col("tt") - F.lit(BASE_MS)).cast("bigint") / F.lit(STREAM_CHUNK_MS)
        part = F.when(F.col("copy") == 0, F.least(F.floor(chunk), F.lit(3))) \
            .when(F.col("copy") == 1, 4).otherwise(5)
    elif split == "whole":
        part = F.lit(0)
    else:
        raise ValueError(f"unknown split {split!r}; use one of {SPLITS}")
    return evaluate_once(m, F.parse_json("metadata").alias("record_metadata"),
                         F.parse_json("content").alias("record_content"),
                         part.cast("int").alias("part"), keep=False)


def part_count(split: str, parts: int = 4) -> int:
    return {"hash": parts, "copies": 3, "redelivered_first": 3, "time_then_copies": 6,
            "whole": 1}[split]
