"""Table locations and small file-system helpers for the derived layers.

Silver is stored partitioned by ``(symbol_key, id_block)`` with
``id_block = trade_id div block_size``: a key always lives in one block, no
matter which trade time a later copy carries, and new trades of a symbol
land in its newest blocks, so an upsert rewrites few partitions.  Gold is
partitioned by ``(minute_date, symbol_key)`` so a touched bar rewrites one
symbol-day of bars.  ``symbol_key`` is a folder-safe, never empty spelling of
the symbol, which itself stays a data column.

Silver, gold and the staging of their batches live in one folder per version;
the newest file under ``_versions`` names the current one.  A rebuild makes a
whole version and then adds one pointer file, so readers see both tables
change at once, and a batch staged against an older version is never applied
to a newer one.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators.gold import GOLD_COLUMNS
from barforge.streaming.edges import EDGES_DDL
from barforge.operators.silver import SILVER_COLUMNS
from barforge.sources.topic import LANDING_PARTS, LANDING_SCHEMA, RAW_LANE

SILVER_DDL = ("event_type string, event_time timestamp_ntz, symbol string, trade_id bigint,"
              " price decimal(38,18), quantity decimal(38,18), buyer_order_id bigint,"
              " seller_order_id bigint, trade_time timestamp_ntz, is_maker boolean,"
              " ingested_at timestamp_ntz, trade_date date, symbol_key string, id_block bigint")
# Stored gold keeps the exact price sum next to the public columns, so the
# mean can be maintained from deltas, and the lists behind the extremes (NULL
# where a rebuild wrote the bar and no batch has recomputed it).
GOLD_DDL = ("symbol string, minute_bucket timestamp_ntz, trade_count bigint,"
            " total_quantity decimal(38,18), total_notional decimal(38,18),"
            " avg_price decimal(38,18), min_price decimal(38,18), max_price decimal(38,18),"
            " first_trade_time timestamp_ntz, last_trade_time timestamp_ntz,"
            f" sum_price decimal(38,18), edges {EDGES_DDL}, minute_date date, symbol_key string")
GOLD_STORED = GOLD_COLUMNS + ("sum_price", "edges", "minute_date", "symbol_key")
# The ledger: what each batch did to each minute (trades gained less trades
# lost, latest ingest), and one row a batch, without a minute, for the raw rows
# it read.
LEDGER_DDL = ("minute_bucket timestamp_ntz, trades bigint, last_ingested timestamp_ntz,"
              " raw_rows bigint, last_raw timestamp_ntz, source string, batch bigint")
LEDGER_PARTS = ("source", "batch")
SILVER_PARTS = ("symbol_key", "id_block")
GOLD_PARTS = ("minute_date", "symbol_key")
FIRST_VERSION = "v0"
DEFAULT_BLOCK = 1_000_000


@dataclass(frozen=True)
class Layout:
    """Where one pipeline keeps its layers (a folder on shared storage).
    ``catalog`` prefixes the schema names of its registered tables;
    ``version`` is filled in by :func:`live`."""

    root: str
    id_block_size: int = DEFAULT_BLOCK
    catalog: str = ""
    version: str = FIRST_VERSION

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def versioned(self, *parts: str) -> str:
        return self.path("versions", self.version, *parts)

    @property
    def bronze(self) -> str:
        return self.path("bronze")

    @property
    def silver(self) -> str:
        return self.versioned("silver")

    @property
    def gold(self) -> str:
        return self.versioned("gold")

    @property
    def ledger(self) -> str:
        return self.versioned("ledger")

    def staging(self, tag: str, batch_id: int, name: str) -> str:
        return self.versioned("_staging", tag, str(batch_id), name)


def live(spark: SparkSession, layout: Layout) -> Layout:
    """The layout at its current version (the newest pointer)."""
    names = sorted(f.rsplit("/", 1)[-1] for f in list_files(spark, layout.path("_versions")))
    return replace(layout, version=names[-1].split("-", 1)[1] if names else FIRST_VERSION)


def point_to(spark: SparkSession, layout: Layout, version: str) -> None:
    """Make ``version`` current: one small new file, never overwritten."""
    n = len(list_files(spark, layout.path("_versions")))
    fs, p = _fs(spark, layout.path("_versions", f"{n:08d}-{version}"))
    fs.create(p, False).close()


def symbol_key(symbol: Column) -> Column:
    """Folder-safe, never empty spelling of a symbol: plain short names are
    kept (prefixed), all others become a digest."""
    plain = symbol.rlike("^[A-Za-z0-9._-]{1,64}$")
    return F.when(plain, F.concat(F.lit("s_"), symbol)).otherwise(F.concat(F.lit("h_"), F.sha1(symbol.cast("binary"))))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [str(s.getPath().toString()) for s in fs.listStatus(p) if s.isDirectory()]


def complete(spark: SparkSession, path: str) -> bool:
    """A Spark write finished (its ``_SUCCESS`` marker exists)."""
    return exists(spark, os.path.join(path, "_SUCCESS"))


def with_block(df: DataFrame, block_size: int) -> DataFrame:
    return (df.withColumn("symbol_key", symbol_key(F.col("symbol")))
            .withColumn("id_block", F.expr(f"trade_id div {int(block_size)}")))


def with_minute_date(df: DataFrame) -> DataFrame:
    return (df.withColumn("minute_date", F.col("minute_bucket").cast("date"))
            .withColumn("symbol_key", symbol_key(F.col("symbol"))))


def stored_bars(silver: DataFrame) -> DataFrame:
    """Gold bars in their stored form (public columns + ``sum_price`` + ``minute_date``),
    without the lists behind their extremes: a full rebuild would have to shuffle
    every price for bars of which few are ever corrected."""
    from barforge.operators.gold import GOLD_KEY, bar_aggregates, with_minute
    rows = with_minute(silver)
    bars = rows.groupBy(*GOLD_KEY).agg(*bar_aggregates(), F.try_sum("price").alias("sum_price"))
    return with_minute_date(bars.withColumn("edges", F.lit(None).cast(EDGES_DDL)))


# Schema and table names of the layers.  The raw table is a view
# of the landing table's raw lane.
TABLE_NAMES = {"landing": "bronze.trades_landing", "bronze": "bronze.trades_raw",
               "silver": "silver.trades_clean", "gold": "gold.trades_1m"}


def table_name(layout: Layout, layer: str) -> str:
    return layout.catalog + TABLE_NAMES[layer]


def _layers(layout: Layout):
    return (("landing", layout.bronze, LANDING_SCHEMA, LANDING_PARTS),
            ("silver", layout.silver, SILVER_DDL, SILVER_PARTS),
            ("gold", layout.gold, GOLD_DDL, GOLD_PARTS))


def bootstrap_layers(spark: SparkSession, layout: Layout, register: bool = False,
                     raw: bool = True) -> None:
    """Create the raw and derived tables when absent (empty, typed);
    idempotent.  With ``register=True`` also ``CREATE SCHEMA/TABLE IF NOT
    EXISTS`` them in the session catalog (external Parquet tables with the
    folders the sinks write, names prefixed per layout).  ``raw=False`` leaves
    the raw folder to a streaming sink, which creates it with its own commit log."""
    check_layout(spark, layout)
    if not list_files(spark, layout.path("_versions")):
        point_to(spark, layout, FIRST_VERSION)
    layout = live(spark, layout)
    for layer, path, ddl, parts in _layers(layout):
        if layer == "landing" and not raw:
            continue
        if not exists(spark, path):
            spark.createDataFrame([], ddl).write.partitionBy(*parts).mode("overwrite").parquet(path)
    if register:
        for layer, path, ddl, parts in _layers(layout):
            name = table_name(layout, layer)
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.split('.')[0]}")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet"
                      f" PARTITIONED BY ({', '.join(parts)}) LOCATION '{path}'")
        spark.sql(f"CREATE VIEW IF NOT EXISTS {table_name(layout, 'bronze')} AS SELECT record_metadata,"
                  f" record_content, trade_time, ingest_date FROM {table_name(layout, 'landing')}"
                  f" WHERE coalesce(lane, '{RAW_LANE}') = '{RAW_LANE}'")
        refresh_tables(spark, layout)


def check_layout(spark: SparkSession, layout: Layout) -> None:
    """Record the block size on first use and refuse a different one later:
    the key -> block mapping must never change for stored rows."""
    marker = layout.path("_layout", f"id_block_size={layout.id_block_size}")
    found = [d.rstrip("/").rsplit("/", 1)[-1] for d in list_dirs(spark, layout.path("_layout"))]
    if not found:
        mkdirs(spark, marker)
    elif found != [f"id_block_size={layout.id_block_size}"]:
        raise ValueError(f"layout {layout.root} was created with {found[0]}, "
                         f"not id_block_size={layout.id_block_size}")


def _spec(names: tuple[str, ...], values: tuple) -> str:
    def lit(v):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"{n} = {lit(v)}" for n, v in zip(names, values))


def register_partitions(spark: SparkSession, layout: Layout, layer: str, names: tuple[str, ...],
                        values: list[tuple], drop: bool = False) -> None:
    """Tell a registered table about partitions a batch wrote (or emptied),
    without listing the whole table.  No-op when the table is not registered."""
    name = table_name(layout, layer)
    if not values or not spark.catalog.tableExists(name):
        return
    verb = "DROP IF EXISTS" if drop else "ADD IF NOT EXISTS"
    specs = [f"PARTITION ({_spec(names, v)})" for v in sorted(set(values), key=str)]
    sep = ", " if drop else " "
    spark.sql(f"ALTER TABLE {name} {verb} {sep.join(specs)}")


def refresh_tables(spark: SparkSession, layout: Layout) -> None:
    """Make registered tables see every partition of the current version
    (lists the whole table: for bootstrap and rebuilds; batches register what
    they touch)."""
    for layer, path, _, _ in _layers(live(spark, layout)):
        name = table_name(layout, layer)
        if not spark.catalog.tableExists(name):
            continue
        if path not in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]:
            for row in spark.sql(f"SHOW PARTITIONS {name}").collect():      # of the old version
                spec = _spec(*zip(*[kv.split("=", 1) for kv in row[0].split("/")]))
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        if exists(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {name}")


def drop_tables(spark: SparkSession, layout: Layout) -> None:
    """Forget the layout's registered tables (external: files stay)."""
    spark.sql(f"DROP VIEW IF EXISTS {table_name(layout, 'bronze')}")
    for layer, *_ in _layers(layout):
        spark.sql(f"DROP TABLE IF EXISTS {table_name(layout, layer)}")


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise RuntimeError(f"rename {src} -> {dst} failed")


def read_silver_stored(spark: SparkSession, layout: Layout) -> DataFrame:
    path = live(spark, layout).silver
    return spark.read.schema(SILVER_DDL).option("basePath", path).parquet(path)


def read_gold_stored(spark: SparkSession, layout: Layout) -> DataFrame:
    path = live(spark, layout).gold
    return spark.read.schema(GOLD_DDL).option("basePath", path).parquet(path)


def ledger_folder(layout: Layout, source: str, batch: int) -> str:
    return partition_path(layout.ledger, LEDGER_PARTS, (source, batch))


def write_ledger(rows: DataFrame, layout: Layout, source: str, batch: int) -> None:
    """One batch's ledger rows; a replay replaces them, so they count once."""
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(ledger_folder(layout, source, batch))


def read_ledger(spark: SparkSession, layout: Layout) -> DataFrame:
    """The ledger of the layout's current version."""
    path = live(spark, layout).ledger
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).option("basePath", path).parquet(path)


def read_silver(spark: SparkSession, layout: Layout) -> DataFrame:
    """The maintained silver table (same columns as the batch rebuild)."""
    return read_silver_stored(spark, layout).select(*SILVER_COLUMNS)


def read_gold(spark: SparkSession, layout: Layout) -> DataFrame:
    """The maintained gold table (same columns as the batch rebuild)."""
    return read_gold_stored(spark, layout).select(*GOLD_COLUMNS)


# Characters Spark escapes (as %XX) in partition folder names --
# ASCII control characters 0x01-0x1F, then " # % ' * / : = ? \ DEL { [ ] ^.
_ESCAPED = set(chr(c) for c in range(1, 0x20)) | set('"#%\'*/:=?\\\x7f{[]^')


def escape_partition_value(value) -> str:
    """A partition value as Spark writes it in a folder name."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def unescape_partition_value(text: str) -> str:
    from urllib.parse import unquote
    return unquote(text)


def partition_path(table: str, names: tuple[str, ...], values: tuple) -> str:
    return os.path.join(table, *[f"{n}={escape_partition_value(v)}"
                                 for n, v in zip(names, values)])


def existing_partitions(spark: SparkSession, table: str, names: tuple[str, ...],
                        values: list[tuple]) -> list[str]:
    """Folders of the wanted partitions that exist.

    One listing per distinct first-level value (a symbol, a day), run in
    parallel -- not one call per partition, which would dominate a batch on
    an object store with thousands of touched blocks.
    """
    from concurrent.futures import ThreadPoolExecutor

    wanted: dict = {}
    for v in set(values):
        wanted.setdefault(v[0], set()).add(tuple(v[1:]))

    def found(first) -> list[str]:
        top = partition_path(table, names[:1], (first,))
        rest = wanted[first]
        if len(names) == 1 or rest == {()}:
            return [top] if exists(spark, top) else []
        have = {d.rstrip("/").rsplit("/", 1)[-1] for d in list_dirs(spark, top)}
        return [partition_path(table, names, (first, *r)) for r in sorted(rest, key=str)
                if f"{names[1]}={escape_partition_value(r[0])}" in have]

    with ThreadPoolExecutor(max_workers=16) as pool:
        return [p for ps in pool.map(found, sorted(wanted, key=str)) for p in ps]


def read_partitions(spark: SparkSession, table: str, ddl: str, names: tuple[str, ...],
                    values: list[tuple]) -> DataFrame:
    """Read only the listed partitions of a path-based table.

    A path-based table lists every partition folder on each read before any
    filter applies; naming the touched folders keeps listing proportional to
    the partitions a batch touches, not to the table.  Missing folders (new
    partitions) are skipped; ``values`` may name a prefix of ``names``.
    """
    paths = existing_partitions(spark, table, names, values)
    if not paths:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("basePath", table).parquet(*paths)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files directly under ``path`` (hidden and marker files skipped)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for f in fs.listStatus(p):
        name = f.getPath().getName()
        if f.isFile() and not name.startswith(("_", ".")):
            out.append(str(f.getPath().toString()))
    return out


def file_counts(spark: SparkSession, table: str, names: tuple[str, ...],
                values: list[tuple]) -> dict[tuple, int]:
    """Number of data files in each listed partition (parallel listings)."""
    from concurrent.futures import ThreadPoolExecutor
    vals = sorted(set(values), key=str)
    with ThreadPoolExecutor(max_workers=16) as pool:
        counts = pool.map(lambda v: len(list_files(spark, partition_path(table, names, v))), vals)
    return dict(zip(vals, counts))


def partition_rows(spark: SparkSession, names: tuple[str, ...], values: list[tuple], ddl: str) -> DataFrame:
    """The listed partitions as a small table to join with (as many rows as a
    batch touches), so no plan grows with their number."""
    return spark.createDataFrame(values, ddl).select(*names)


def stage(df: DataFrame, path: str, partition_by: tuple[str, ...] | None = None) -> None:
    """Durably write ``df``, overwriting an earlier attempt.

    Partitioned stages are clustered by their partition columns first, so
    each partition is one file rather than one file per task; silver rows are
    also time-ordered inside a file, so row-group min/max on ``trade_time``
    prune later scans.
    """
    w = df
    if partition_by:
        w = w.repartition(*partition_by)
        if "trade_time" in df.columns:
            w = w.sortWithinPartitions(*partition_by, "trade_time")
    writer = w.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish(df: DataFrame, path: str, parts: tuple[str, ...]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def distinct_keys(df: DataFrame, cols: tuple[str, ...]) -> list[tuple]:
    """Partition keys touched by a batch (bounded by partitions, not rows)."""
    return [tuple(r) for r in df.select(*cols).distinct().collect()]


def staged_partitions(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Partition folders of a two-level staged write, as (first, second) texts."""
    def value(folder: str) -> str:
        return unescape_partition_value(folder.rstrip("/").rsplit("/", 1)[-1].split("=", 1)[1])

    return [(value(d1), value(d2)) for d1 in list_dirs(spark, path)
            for d2 in list_dirs(spark, d1)]


def drop_older_stages(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Delete the staging of batches before ``batch_id`` (they have committed)."""
    for d in list_dirs(spark, folder):
        name = d.rstrip("/").rsplit("/", 1)[-1]
        if name.isdigit() and int(name) < batch_id:
            delete(spark, d)
