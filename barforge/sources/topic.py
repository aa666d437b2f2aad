"""Topic source, raw-layer sink, metadata capture, raw scan and
idempotent layer creation.

The topic source has the Kafka row schema.  Production reads Kafka
(``format('kafka')``, jar supplied by the cluster) or a log of segment files
with offsets per partition (``sources/segments.py``); the same schema is also
served from plain files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barforge.functions.jsonpath import json_time_ntz
from barforge.operators.admission import classify, unwrap_envelope
from barforge.operators.silver import rejected_fields
from barforge.sources.segments import TOPIC_SCHEMA, read_segments_stream

RAW_SCHEMA = "record_metadata variant, record_content variant"
BRONZE_SCHEMA = RAW_SCHEMA + ", trade_time timestamp_ntz, ingest_date date"
# The sink flushes at this many records, bytes or seconds.
FLUSH_RECORDS, FLUSH_BYTES, FLUSH_SECONDS = 1000, 5_000_000, 10
# The ingest sink writes one folder with three lanes: admitted raw rows,
# quarantined messages (original text + reason) and, beside their raw rows,
# the fields that permissive parsing will not read (field, its text, reason).
RAW_LANE, QUARANTINE_LANE, REJECTS_LANE = "raw", "quarantine", "rejects"
# The typed trade time stands beside the payload, so that time bounds on the
# raw layer skip row groups and read one column.
LANDING_SCHEMA = (RAW_SCHEMA + ", trade_time timestamp_ntz, raw_value string, reason string,"
                  " field string, lane string, ingest_date date")
LANDING_PARTS = ("lane", "ingest_date")


def read_trades_stream(spark: SparkSession, source: str = "files", path: str | None = None,
                       topic: str = "crypto_trades", max_per_trigger: int | None = None,
                       checkpoint: str | None = None, **options) -> DataFrame:
    """The trade topic as a stream with key, value, topic, partition,
    offset and timestamp.

    ``source='kafka'`` reads a broker (``kafka.bootstrap.servers`` in
    ``options``; ``maxOffsetsPerTrigger`` bounds a micro-batch);
    ``source='segments'`` reads a log of segment files by offsets per
    partition, with the same bound and, given the ingest query's
    ``checkpoint``, the flush rule: a batch is cut at 1,000 records, 5 MB or
    10 s, whichever comes first; ``source='files'`` reads Parquet files with
    the same schema.
    """
    if source == "segments":
        if path is None:
            raise ValueError("path is required for the segment source")
        if checkpoint:
            options = {"checkpoint": checkpoint, "minOffsetsPerTrigger": FLUSH_RECORDS,
                       "minBytesPerTrigger": FLUSH_BYTES, "maxTriggerDelay": FLUSH_SECONDS} | options
        if max_per_trigger:
            options = {"maxOffsetsPerTrigger": max_per_trigger} | options
        return read_segments_stream(spark, path, topic, **options)
    if source == "kafka":
        reader = (spark.readStream.format("kafka").option("subscribe", topic)
                  .option("startingOffsets", "earliest"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        for k, v in options.items():
            reader = reader.option(k, v)
        raw = reader.load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"),
                          "topic", "partition", "offset", "timestamp")
    if path is None:
        raise ValueError("path is required for the file source")
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.parquet(path).filter(F.col("topic") == topic)


def read_topic(spark: SparkSession, path: str, topic: str = "crypto_trades") -> DataFrame:
    """Batch read of topic rows from files (same schema as the stream)."""
    return spark.read.schema(TOPIC_SCHEMA).parquet(path).filter(F.col("topic") == topic)


def with_record_metadata(df: DataFrame) -> DataFrame:
    """The record metadata object the sink stores next to the payload:
    ``{"CreateTime": ms, "topic": .., "partition": .., "offset": ..}``."""
    meta = F.named_struct(F.lit("CreateTime"), F.unix_millis(F.col("timestamp")),
                          F.lit("topic"), F.col("topic"),
                          F.lit("partition"), F.col("partition"),
                          F.lit("offset"), F.col("offset"))
    return df.withColumn("record_metadata", F.to_variant_object(meta))


def ingest_date(ts_col: str = "timestamp"):
    """UTC calendar date of a record timestamp (zone-proof)."""
    return F.date_from_unix_date(F.floor(F.unix_millis(F.col(ts_col)) / 86400000).cast("int"))


def to_bronze(admitted: DataFrame) -> DataFrame:
    """Admitted topic rows -> raw-layer rows (+ typed ``trade_time`` and
    ``ingest_date`` for pruning)."""
    return with_record_metadata(admitted).select(
        "record_metadata", F.col("payload").alias("record_content"),
        json_time_ntz("payload", "T").alias("trade_time"),
        ingest_date().alias("ingest_date"))


def to_landing(messages: DataFrame) -> DataFrame:
    """S2 + S7 + F2/F3 in one pass: every message, parsed once, lands in its
    lane -- ``raw`` (metadata + payload) or ``quarantine`` (metadata, original
    text and the reason); a raw row's rejected fields land in ``rejects``."""
    tagged = classify(unwrap_envelope(messages))
    ok = F.col("reason").isNull()
    none = F.lit(None).cast("string")
    whole = F.struct(F.when(~ok, F.col("value")).alias("raw_value"), F.col("reason").alias("why"), none.alias("field"),
                     F.when(ok, F.lit(RAW_LANE)).otherwise(F.lit(QUARANTINE_LANE)).alias("lane"))
    fields = F.transform(rejected_fields("payload"), lambda x: F.struct(
        x["value"].alias("raw_value"), x["reason"].alias("why"), x["field"].alias("field"), F.lit(REJECTS_LANE).alias("lane")))
    laned = with_record_metadata(tagged).select(
        "record_metadata", "payload", ingest_date().alias("ingest_date"),
        F.inline(F.when(ok, F.concat(F.array(whole), fields)).otherwise(F.array(whole))))
    raw = F.col("lane") == RAW_LANE
    return laned.select(
        "record_metadata", F.when(raw, F.col("payload")).alias("record_content"),
        F.when(raw, json_time_ntz("payload", "T")).alias("trade_time"),
        "raw_value", F.col("why").alias("reason"), "field", "lane", "ingest_date")


def write_bronze(stream: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Topic stream -> admission -> raw layer (append), rejected messages
    -> quarantine lane, rejected fields -> rejects lane.

    One file-sink query: each message is read and parsed once, the output is
    exactly-once, and its commit log lets a downstream stream read new raw
    files without listing the folder.  A bad message never stops the
    stream.  ``trigger`` defaults to ``processingTime='10 seconds'`` (the
    reference's flush interval).
    """
    return (to_landing(stream).writeStream.format("parquet")
            .partitionBy(*LANDING_PARTS).option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def raw_lane(df: DataFrame) -> DataFrame:
    """Admitted rows of a landing folder (rows written without lanes count as raw)."""
    return df.filter(F.coalesce(F.col("lane"), F.lit(RAW_LANE)) == RAW_LANE).select(
        "record_metadata", "record_content", "trade_time", "ingest_date")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Raw-layer scan (the ``raw`` lane; the lane filter prunes folders)."""
    return raw_lane(spark.read.schema(LANDING_SCHEMA).parquet(path))


def read_bronze_stream(spark: SparkSession, path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """The raw layer as a stream (through the ingest sink's commit log).
    ``max_files_per_trigger`` bounds a micro-batch, so a backlog is consumed
    in bounded upserts."""
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return raw_lane(reader.parquet(path))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined messages: metadata, original text and reason."""
    df = spark.read.schema(LANDING_SCHEMA).parquet(path)
    return df.filter(F.col("lane") == QUARANTINE_LANE).select(
        "record_metadata", "raw_value", "reason", "ingest_date")


def read_rejected_fields(spark: SparkSession, path: str) -> DataFrame:
    """F2/F3 lane: a raw row's metadata and each field of it that reads as
    NULL downstream although the payload holds a value."""
    df = spark.read.schema(LANDING_SCHEMA).parquet(path)
    return df.filter(F.col("lane") == REJECTS_LANE).select(
        "record_metadata", "field", F.col("raw_value").alias("value"), "reason", "ingest_date")
