"""Keep silver and gold equal to the full rebuild, one
micro-batch at a time (``foreachBatch``), with no watermark and no late drop.

Per batch:

1. winners of the batch itself (parse -> validity filter -> keep-latest),
   cached (recomputable from the batch's source files); the parse belongs to
   the streaming plan, where the scan reads only the VARIANT paths it names (a
   batch handed to ``foreachBatch`` has no scan to push them into);
2. the stored rows of the same keys are read from the touched
   ``(symbol_key, id_block)`` partitions only and merged with the same total
   order as the batch rebuild; touched partitions are joined with, never
   spelled out in a plan;
3. blocks where a stored row is replaced are staged whole -- kept rows,
   winners, and the replaced rows tagged by role -- while blocks that only
   gain new trades stage just the winners, to be appended; the per-bar delta
   (winners +, replaced rows -) is staged last, and its completion marks the
   batch as staged;
4. rewritten blocks replace their partitions (dynamic overwrite) and
   appended files move into their blocks under names made of stream, batch
   and the staged file's own name;
5. touched bars are updated from the batch delta: counts and exact decimal
   sums (including the price sum behind the mean) are retractable, and so are
   MIN/MAX while the bar's stored lists of least and largest values last
   (``edges``); only a bar whose list is exhausted, or that has none and lost
   an extreme, is recomputed from its silver rows.  Bars that became empty
   disappear;
6. the ledger gets the batch's rows: the per-minute sums of its bar delta and
   what it observed of the raw rows on the way (no further pass).

Stages live in the version of the tables they were computed against, so a
rebuild leaves them behind.  :func:`compact` merges the files of blocks that
many batches have appended to; it is an operation of its own.

Keep-latest is a per-key maximum under a total order, so applying a batch
twice, or after a partial publish, gives the same tables: a replayed batch
re-publishes its staged output.  Row state lives in storage, not in the
state store, so it is not bounded by executor memory.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barforge.functions.decimal import limb_total, negated, with_limbs
from barforge.functions.timefn import minute_bucket, ntz_literal
from barforge.operators.checks import bronze_trade_time
from barforge.operators.silver import (KEY, dedup_latest, parse_trades, silver_projection,
                                       valid_trades)
from barforge.streaming import edges as eg
from barforge.streaming import storage as st
from barforge.streaming.storage import Layout

TOUCHED = ("symbol", "minute_bucket")
RAW_TIME = "raw_time"
_ONE_MINUTE = _dt.timedelta(minutes=1)


_stage, _publish, _distinct_keys = st.stage, st.publish, st.distinct_keys


# Role of a staged silver row: kept as is, the batch's winner for its key, or
# the stored version it replaces (staged only to know which bars it left).
KEPT, WINNER, REPLACED = "kept", "winner", "replaced"
STAGED_DDL = st.SILVER_DDL + ", role string"
SILVER_PART_DDL = "symbol_key string, id_block bigint"


@dataclass(frozen=True)
class Staged:
    """Durable outputs of one batch, written before anything is published."""

    rewrite: str    # new content of blocks that change (roles kept/winner/replaced)
    append: str     # winners of blocks that only gain new trades
    raw: str        # what was observed of the raw rows (one row)
    delta: str      # per-bar changes; its _SUCCESS marks the whole stage complete


def typed_rows(raw: DataFrame, mode: str = "permissive") -> DataFrame:
    """Raw rows as a batch takes them: parsed, with the raw row's own trade
    time (``raw_time``).  Rows that are typed already stay as they are."""
    if RAW_TIME in raw.columns:
        return raw
    return parse_trades(raw.withColumn(RAW_TIME, bronze_trade_time(raw)), mode, keep=(RAW_TIME,))


def stage_silver(batch: DataFrame, batch_id: int, layout: Layout, tag: str,
                 mode: str = "permissive") -> Staged | None:
    """Steps 1-3: stage the batch's silver changes and bar delta.

    A touched block is *rewritten* (copy-on-write) only when the batch
    replaces one of its stored rows; otherwise the batch's winners are
    *appended* to it as new files, so a block that only gains new trades is
    never re-read or re-written.  Returns None for a batch without valid rows.
    ``layout`` must be at its current version (see ``storage.live``).
    """
    spark = batch.sparkSession
    staged = Staged(*(layout.staging(tag, batch_id, n)
                      for n in ("silver_rewrite", "silver_append", "raw_seen", "bar_delta")))
    if st.complete(spark, staged.delta):
        return staged                                   # replay: publish what was staged

    seen = Observation()
    measures = [F.count(F.lit(1)).alias("raw_rows"), F.max(RAW_TIME).alias("last_raw")]
    unseen = typed_rows(batch, mode)
    batch = unseen.observe(seen, *measures).drop(RAW_TIME)
    # Cached, not staged: a lost cache block is recomputed from the batch's
    # source files, which stay in place until the batch commits.
    incoming = st.with_block(silver_projection(dedup_latest(valid_trades(batch))),
                             layout.id_block_size).persist(StorageLevel.MEMORY_AND_DISK)
    previous = winners = None
    try:
        # Touched blocks and the trade-id range of the batch (as many rows as
        # touched blocks; the trigger's file limit bounds a batch).
        touched = [tuple(r) for r in incoming.groupBy(*st.SILVER_PARTS).agg(
            F.min("trade_id"), F.max("trade_id")).collect()]
        if not touched:
            # Plans that come out empty may report no observation.
            st.write_ledger(_ledger_rows(unseen.agg(*measures), None), layout, tag, batch_id)
            return None
        _stage(spark.createDataFrame([(seen.get["raw_rows"], seen.get["last_raw"])], "raw_rows bigint, last_raw timestamp_ntz"), staged.raw)
        blocks = [t[:2] for t in touched]
        low, high = min(t[2] for t in touched), max(t[3] for t in touched)
        on = [*KEY, *st.SILVER_PARTS]
        keys = incoming.select(*on)
        # Stored rows of the batch's keys (at most one per incoming key); the
        # id range lets Parquet statistics skip what cannot match.
        current = st.read_partitions(spark, layout.silver, st.SILVER_DDL, st.SILVER_PARTS, blocks)
        previous = current.filter(F.col("trade_id").between(low, high)).join(keys, on, "left_semi") \
            .persist(StorageLevel.MEMORY_AND_DISK)
        rewrite = sorted(_distinct_keys(previous, st.SILVER_PARTS), key=str)
        rewritten = st.partition_rows(spark, st.SILVER_PARTS, rewrite, SILVER_PART_DDL)

        winners = dedup_latest(incoming.unionByName(previous)).persist(StorageLevel.MEMORY_AND_DISK)
        # Empty stages are not written (a leftover of an earlier attempt is
        # removed); readers treat a missing stage as empty.
        st.delete(spark, staged.rewrite)
        st.delete(spark, staged.append)
        parts = list(st.SILVER_PARTS)
        if rewrite:
            untouched = st.read_partitions(spark, layout.silver, st.SILVER_DDL, st.SILVER_PARTS,
                                           rewrite).join(keys, on, "left_anti")
            _stage(untouched.withColumn("role", F.lit(KEPT))
                   .unionByName(winners.join(rewritten, parts, "left_semi").withColumn("role", F.lit(WINNER)))
                   .unionByName(previous.withColumn("role", F.lit(REPLACED))),
                   staged.rewrite, st.SILVER_PARTS)
        if len(rewrite) < len(blocks):
            _stage(winners.join(rewritten, parts, "left_anti"), staged.append, st.SILVER_PARTS)
        rows = (_read_stage(spark, staged.rewrite, STAGED_DDL)
                .unionByName(_read_stage(spark, staged.append, st.SILVER_DDL)
                             .withColumn("role", F.lit(WINNER))))
        _stage(st.with_minute_date(bar_changes(rows)), staged.delta)
    finally:
        for df in (incoming, previous, winners):
            if df is not None:
                df.unpersist()
    return staged


def _ledger_rows(raw: DataFrame, changes: DataFrame | None) -> DataFrame:
    """A batch's ledger rows, from what it saw of the raw rows and its bar delta."""
    rows = raw.select(F.lit(None).cast("timestamp_ntz").alias("minute_bucket"), F.lit(0).cast("bigint").alias("trades"),
                      F.lit(None).cast("timestamp_ntz").alias("last_ingested"), "raw_rows", "last_raw")
    if changes is None:
        return rows
    minutes = changes.groupBy("minute_bucket").agg(F.sum("trade_count").alias("trades"), F.max("last_ingested").alias("last_ingested"))
    return rows.unionByName(minutes.select("*", F.lit(0).cast("bigint").alias("raw_rows"), F.lit(None).cast("timestamp_ntz").alias("last_raw")))


def _read_stage(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    if not st.exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def publish_silver(spark: SparkSession, staged: Staged, layout: Layout, tag: str,
                   batch_id: int) -> None:
    """Step 4: rewritten blocks replace their partitions; appended files are
    moved into their blocks under (stream, batch, staged file name), so a
    replay moves only what is left, and takes a staged file for moved only
    when that very file is at its target."""
    rewritten = st.staged_partitions(spark, staged.rewrite)
    if rewritten:
        rw = spark.read.schema(STAGED_DDL).parquet(staged.rewrite)
        _publish(rw.filter(F.col("role") != REPLACED).drop("role"), layout.silver,
                 st.SILVER_PARTS)
    parts = st.staged_partitions(spark, staged.append)

    def move_block(part) -> None:
        src_dir = st.partition_path(staged.append, st.SILVER_PARTS, part)
        dst_dir = st.partition_path(layout.silver, st.SILVER_PARTS, part)
        for src in sorted(st.list_files(spark, src_dir)):
            dst = f"{dst_dir}/{tag}-{batch_id:012d}-{src.rsplit('/', 1)[-1]}"
            if st.exists(spark, dst):
                st.delete(spark, src)                 # copied by an earlier attempt
            else:
                st.rename(spark, src, dst)

    with ThreadPoolExecutor(max_workers=16) as pool:
        list(pool.map(move_block, parts))
    st.register_partitions(spark, layout, "silver", st.SILVER_PARTS, rewritten + parts)


BAR_SUMS = ("trade_count", "total_quantity", "total_notional", "sum_price")
BAR_EXTREMES = (("min_price", F.min), ("max_price", F.max),
                ("first_trade_time", F.min), ("last_trade_time", F.max))


def bar_changes(staged: DataFrame) -> DataFrame:
    """Per touched bar: signed sums of the batch's winners (+) and of the rows
    they replace (-), extremes of the winners, extremes of the replaced rows
    (``gone_*``), and the net changes at either end (``edges``).  Batch-sized."""
    win = F.col("role") == WINNER
    c = with_limbs(staged.filter(F.col("role") != KEPT).select(
        "symbol", minute_bucket(F.col("trade_time")).alias("minute_bucket"), "role", "price",
        "quantity", "trade_time", "ingested_at"))

    def signed(x):
        return F.when(win, x).otherwise(negated(x))

    sign = F.when(win, 1).otherwise(-1)
    ends = eg.edge_lists(c.select(*TOUCHED, "price", "trade_time", sign.alias("sign")), eg.CHANGES)
    sums = c.groupBy(*TOUCHED).agg(
        F.sum(sign).cast("bigint").alias("trade_count"),
        F.try_sum(signed(F.col("quantity"))).alias("total_quantity"),
        limb_total(sign).alias("total_notional"),
        F.try_sum(signed(F.col("price"))).alias("sum_price"),
        F.max(F.when(win, F.col("ingested_at"))).alias("last_ingested"),
        *[fn(F.when(win, F.col(src))).alias(name)
          for name, fn, src in (("min_price", F.min, "price"), ("max_price", F.max, "price"),
                                ("first_trade_time", F.min, "trade_time"),
                                ("last_trade_time", F.max, "trade_time"))],
        *[fn(F.when(~win, F.col(src))).alias(f"gone_{name}")
          for name, fn, src in (("min_price", F.min, "price"), ("max_price", F.max, "price"),
                                ("first_trade_time", F.min, "trade_time"),
                                ("last_trade_time", F.max, "trade_time"))],
    )
    return sums.join(ends, list(TOUCHED), "left")


def merge_bars(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored bars + batch changes -> new bars.  Sums are exact decimals.

    ``lost`` flags bars whose extremes cannot be told: a list behind them is
    exhausted or, for a bar stored without lists, a replaced row held an extreme
    that no winner reaches.  ``inconsistent`` flags bars whose stored state does
    not cover what is being removed (a negative count, removals from a bar that
    is not stored, or a sum that is NULL).  Both are recomputed from silver.
    """
    gone = [f"gone_{n}" for n, _ in BAR_EXTREMES]
    stored = current.select(*TOUCHED, *BAR_SUMS, *[n for n, _ in BAR_EXTREMES],
                            *[F.lit(None).alias(g) for g in gone], "edges", F.lit(True).alias("_stored"))
    delta = changes.select(*TOUCHED, *BAR_SUMS, *[n for n, _ in BAR_EXTREMES], *gone,
                           "edges", F.lit(False).alias("_stored"))
    u = stored.unionByName(delta)
    s = F.col("_stored")
    m = u.groupBy(*TOUCHED).agg(
        *[F.try_sum(n).alias(n) for n in BAR_SUMS],
        # A NULL sum (a product or total out of range) cannot be retracted.
        reduce(lambda a, b: a | b, [F.bool_or(F.col(n).isNull()) for n in BAR_SUMS]).alias("_unknown"),
        *[fn(n).alias(n) for n, fn in BAR_EXTREMES],
        *[fn(F.when(s, F.col(n))).alias(f"old_{n}") for n, fn in BAR_EXTREMES],
        *[fn(F.when(~s, F.col(n))).alias(f"win_{n}") for n, fn in BAR_EXTREMES],
        *[fn(F.col(f"gone_{n}")).alias(f"gone_{n}") for n, fn in BAR_EXTREMES],
        F.first(F.when(s, F.col("edges")), ignorenulls=True).alias("_old"),
        F.first(F.when(~s, F.col("edges")), ignorenulls=True).alias("_new"),
        F.bool_or(~s).alias("_changed"),
        F.max(s.cast("int")).alias("_had_row"))
    # A bar without lists gets them when it is recomputed; a new one has them.
    old = F.when(F.col("_had_row") == 0, eg.whole_and_empty()).otherwise(F.col("_old"))
    changed = eg.merged(old, F.coalesce("_new", eg.whole_and_empty()))
    m = m.withColumn("edges", F.when(old.isNotNull(), F.when(F.col("_changed"), changed).otherwise(old)))
    edges, listed = F.col("edges"), F.col("edges").isNotNull()

    def lost(n, fn):
        # The stored extreme may be gone when a replaced row reached it, unless
        # a winner of the same bar reaches it too (then the new extreme is
        # exactly the merged one).
        reaches = (lambda a, b: a <= b) if fn is F.min else (lambda a, b: a >= b)
        gone_hit = F.coalesce(reaches(F.col(f"gone_{n}"), F.col(f"old_{n}")), F.lit(False))
        win_hit = F.coalesce(reaches(F.col(f"win_{n}"), F.col(f"old_{n}")), F.lit(False))
        return gone_hit & ~win_hit

    lost_extreme = F.when(listed, eg.exhausted(edges)).otherwise(
        reduce(lambda a, b: a | b, [lost(n, fn) for n, fn in BAR_EXTREMES]))
    inconsistent = F.col("_unknown") | (F.col("trade_count") < 0) | (
        F.col("gone_min_price").isNotNull() & F.coalesce(F.col("_had_row") == 0, F.lit(True))) | (
        F.coalesce(eg.contradicts(edges), F.lit(False)))
    return m.select(
        *TOUCHED, *BAR_SUMS, *[F.when(listed, eg.extreme(edges, n)).otherwise(F.col(n)).alias(n) for n, _ in BAR_EXTREMES],
        "edges", lost_extreme.alias("lost"), inconsistent.alias("inconsistent"))


def refresh_gold(spark: SparkSession, delta_path: str, batch_id: int, layout: Layout,
                 tag: str) -> None:
    """Step 5: merge the batch's bar changes into the touched gold partitions.

    Only bars flagged stale are recomputed from silver (their rows only);
    all others come from stored bars plus the batch delta, so the common
    case reads no silver at all.  Bars whose count drops to zero disappear.
    """
    gold_stage = layout.staging(tag, batch_id, "gold_parts")
    changes = spark.read.parquet(delta_path).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Touched symbol-days (as many rows as the batch touches), and whether
        # a bar may need its silver rows: a batch of new trades only cannot
        # leave one stale.
        parts = sorted(_distinct_keys(changes, st.GOLD_PARTS), key=str)
        if not parts:
            return
        if not st.complete(spark, gold_stage):
            # The gold stage completes before anything in gold is replaced,
            # so a replay either re-publishes it or recomputes it from scratch.
            current = st.read_partitions(spark, layout.gold, st.GOLD_DDL, st.GOLD_PARTS, parts)
            merged = merge_bars(current, changes).persist(StorageLevel.MEMORY_AND_DISK)
            alive = F.col("trade_count") > 0
            redo = (F.col("lost") & alive) | F.col("inconsistent")
            stale = st.with_minute_date(merged.filter(redo).select(*TOUCHED))
            fresh = merged.filter(~F.col("lost") & ~F.col("inconsistent") & alive).select(
                *TOUCHED, *BAR_SUMS, *[n for n, _ in BAR_EXTREMES], "edges",
                (F.col("sum_price") / F.col("trade_count")).cast("decimal(38,18)").alias("avg_price"))
            out = st.with_minute_date(fresh).select(*st.GOLD_STORED)
            if not stale.isEmpty():
                out = out.unionByName(_recompute(spark, layout, stale))
            _stage(out, gold_stage, st.GOLD_PARTS)
            merged.unpersist()
    finally:
        changes.unpersist()

    _publish(spark.read.schema(st.GOLD_DDL).parquet(gold_stage), layout.gold, st.GOLD_PARTS)
    # A symbol-day whose bars all moved away has no output row, so dynamic
    # overwrite would leave it in place: remove such partitions explicitly.
    present = set(st.staged_partitions(spark, gold_stage))
    emptied = [(day, key) for day, key in parts if (str(day), key) not in present]
    for day, key in emptied:
        st.delete(spark, st.partition_path(layout.gold, st.GOLD_PARTS, (day, key)))
    st.register_partitions(spark, layout, "gold", st.GOLD_PARTS, sorted(present))
    st.register_partitions(spark, layout, "gold", st.GOLD_PARTS, emptied, drop=True)


def _recompute(spark: SparkSession, layout: Layout, stale: DataFrame) -> DataFrame:
    """Full bars for the stale keys, from the silver rows of those bars only
    (symbol folders and the time range prune the scan)."""
    info = stale.agg(F.min("minute_bucket").alias("lo"), F.max("minute_bucket").alias("hi")).first()
    if info.lo is None:
        return spark.createDataFrame([], st.GOLD_DDL).select(*st.GOLD_STORED)
    silver = (st.read_partitions(spark, layout.silver, st.SILVER_DDL, st.SILVER_PARTS,
                                 _distinct_keys(stale, ("symbol_key",)))
              .filter((F.col("trade_time") >= ntz_literal(info.lo))
                      & (F.col("trade_time") < ntz_literal(info.hi + _ONE_MINUTE))))
    rows = silver.withColumn("minute_bucket", minute_bucket(F.col("trade_time")))
    rows = rows.join(stale.select(*TOUCHED), list(TOUCHED), "left_semi").drop("minute_bucket")
    ends = eg.edge_lists(rows.select("symbol", minute_bucket(F.col("trade_time")).alias("minute_bucket"), "price", "trade_time",
                                     F.lit(1).alias("sign")), eg.KEEP)
    return st.stored_bars(rows).drop("edges").join(ends, list(TOUCHED), "left").select(*st.GOLD_STORED)


def upsert_batch(batch: DataFrame, batch_id: int, layout: Layout, tag: str = "default",
                 mode: str = "permissive") -> None:
    """One micro-batch of T1 + T2 (see module doc)."""
    spark = batch.sparkSession
    layout = st.live(spark, layout)
    # A batch that is applied anew after its stage is gone changes nothing, and
    # the ledger has its rows.
    noted = st.complete(spark, st.ledger_folder(layout, tag, batch_id)) and not st.complete(
        spark, layout.staging(tag, batch_id, "bar_delta"))
    staged = stage_silver(batch, batch_id, layout, tag, mode)
    if staged is None:
        return
    publish_silver(spark, staged, layout, tag, batch_id)
    refresh_gold(spark, staged.delta, batch_id, layout, tag)
    if not noted:
        st.write_ledger(_ledger_rows(spark.read.parquet(staged.raw), spark.read.parquet(staged.delta)), layout, tag, batch_id)
    st.drop_older_stages(spark, layout.versioned("_staging", tag), batch_id)


def stream_tag(checkpoint: str) -> str:
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:12]


def maintain(stream: DataFrame, layout: Layout, checkpoint: str, trigger: dict | None = None,
             mode: str = "permissive", query_name: str | None = None) -> StreamingQuery:
    """T1 + T2 as one streaming query over the raw layer.

    ``trigger`` defaults to ``processingTime='60 seconds'`` (the reference's
    freshness target); tests use ``{'availableNow': True}``.
    """
    spark = stream.sparkSession
    st.bootstrap_layers(spark, layout)
    tag = stream_tag(checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, layout, tag, mode)

    writer = typed_rows(stream, mode).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def rebuild(bronze: DataFrame, layout: Layout, mode: str = "permissive") -> str:
    """Recompute silver and gold from all raw rows (no date range) into a
    new version, then point the layout to it.

    Readers see the old pair of tables until the pointer is written and the
    new pair afterwards, never a mix; a crash before that leaves the layout
    as it was.  Staged batches stay behind with the old version.  Run it with
    the maintenance stream stopped.  ``mode`` is the stream's default; values
    that permissive parsing rejects are listed by ``silver.cast_rejects``.
    Returns the version id; the version it replaces is kept until the next
    rebuild, older ones are deleted.
    """
    from barforge.operators.silver import silver_trades
    spark = bronze.sparkSession
    old = st.live(spark, layout)
    fresh = replace(layout, version=uuid.uuid4().hex[:12])
    # De-dup first (map-side limited), then cluster by block: one file per
    # block, and no block can be skewed (it holds at most N trade ids).
    silver = st.with_block(silver_trades(bronze, mode), layout.id_block_size)
    (silver.repartition(*st.SILVER_PARTS).sortWithinPartitions(*st.SILVER_PARTS, "trade_time")
     .write.partitionBy(*st.SILVER_PARTS).parquet(fresh.silver))
    rows = spark.read.schema(st.SILVER_DDL).option("basePath", fresh.silver).parquet(fresh.silver)
    (st.stored_bars(rows).select(*st.GOLD_STORED).repartition(*st.GOLD_PARTS)
     .write.partitionBy(*st.GOLD_PARTS).parquet(fresh.gold))
    raw = bronze.agg(F.count(F.lit(1)).alias("raw_rows"), F.max(bronze_trade_time(bronze)).alias("last_raw"))
    counted = rows.select(minute_bucket(F.col("trade_time")).alias("minute_bucket"), F.lit(1).alias("trade_count"), F.col("ingested_at").alias("last_ingested"))
    st.write_ledger(_ledger_rows(raw, counted), fresh, "rebuild", 0)
    st.point_to(spark, layout, fresh.version)
    for folder in st.list_dirs(spark, layout.path("versions")):
        if folder.rstrip("/").rsplit("/", 1)[-1] not in (old.version, fresh.version):
            st.delete(spark, folder)
    st.refresh_tables(spark, layout)
    return fresh.version


def compact(spark: SparkSession, layout: Layout, min_files: int = 2) -> int:
    """Merge the files of every silver block that has ``min_files`` or more
    into one; returns the number of blocks.  Run it with the stream stopped,
    as often as reading many small files costs more than this does.  The new
    content is staged whole before any block is replaced."""
    layout = st.live(spark, layout)
    blocks = [b for b, n in st.file_counts(spark, layout.silver, st.SILVER_PARTS,
                                           st.staged_partitions(spark, layout.silver)).items() if n >= min_files]
    if blocks:
        stage = layout.staging("compact", 0, uuid.uuid4().hex[:12])
        _stage(st.read_partitions(spark, layout.silver, st.SILVER_DDL, st.SILVER_PARTS, blocks), stage, st.SILVER_PARTS)
        _publish(spark.read.schema(st.SILVER_DDL).parquet(stage), layout.silver, st.SILVER_PARTS)
        st.delete(spark, stage)
    return len(blocks)
