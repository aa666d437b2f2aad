"""The whole streaming pipeline: topic -> admission -> raw layer -> silver
and gold maintenance, as two streaming queries sharing one layout.

    topic stream --S1/S2/S6--> landing (one exactly-once file sink)
                                 lane=raw        --T1/T2--> silver, gold
                                 lane=quarantine

The maintenance query reads the raw layer through the file sink's metadata
log, so it only sees committed raw files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barforge.operators.admission import filter_symbols
from barforge.sources.topic import read_bronze_stream, write_bronze
from barforge.streaming import maintain as mt
from barforge.streaming import storage as st


#: Raw files a maintenance batch takes at most: with the sink's flushes every
#: ten seconds, a backlog is worked off in bounded upserts.
MAX_RAW_FILES = 512


def start_streams(spark: SparkSession, topic_stream: DataFrame, layout: st.Layout,
                   checkpoint_root: str, ingest_trigger: dict | None = None,
                   maintain_trigger: dict | None = None, mode: str = "permissive",
                   max_raw_files_per_trigger: int | None = MAX_RAW_FILES,
                   symbols: tuple[str, ...] | None = None,
                   register: bool = False) -> list[StreamingQuery]:
    """Start ingest (raw + quarantine lanes) and maintenance; returns the
    queries in that order.  Triggers default to 10 s (sink flush) and 60 s
    (freshness target).  ``symbols`` (see ``admission.parse_symbols``) keeps
    the subscribed symbols' messages, by key; ``register`` registers the
    layers' tables."""
    st.bootstrap_layers(spark, layout, raw=False, register=register)
    if symbols:
        topic_stream = filter_symbols(topic_stream, symbols, "key")
    ingest = write_bronze(topic_stream, layout.bronze, os.path.join(checkpoint_root, "ingest"),
                          ingest_trigger)
    raw = read_bronze_stream(spark, layout.bronze, max_raw_files_per_trigger)
    maintain = mt.maintain(raw, layout,
                           os.path.join(checkpoint_root, "maintain"), maintain_trigger, mode)
    return [ingest, maintain]


def catch_up(queries: list[StreamingQuery]) -> None:
    """Process everything available, upstream first (tests and backfills)."""
    for q in queries:
        q.processAllAvailable()
