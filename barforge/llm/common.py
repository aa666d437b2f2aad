"""Helpers shared by the operators: written intermediate tables, text folding,
distributed ranks and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir``
    as the session has it.  Only where it is unset, on a local master (tests),
    a folder of this application under the JVM's temporary directory."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{sc._jvm.System.getProperty('java.io.tmpdir')}/llm-{sc.applicationId}"
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, reread: cuts the lineage
    and survives lost executors."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the folder of a table made by ``written`` once nothing reads it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def byte_slices(batch: pa.RecordBatch, limit: int = 1 << 20, column: int = 0) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text (in ``column``), a row at
    least: what a task makes of a slice stays small whatever the batch holds."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        n = max(1, int(np.searchsorted(sizes, before + limit, side="right")) - at)
        yield batch.slice(at, n)
        at += n


def held_out(doc_id: Column) -> Column:
    """The fixed split: crc32(doc_id as text) mod 5 is 0 for held-out rows."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def global_rank(df: DataFrame, keys: list[str], out: str, name: str, start: int = 0) -> DataFrame:
    """``df`` with the row's place in the total order of ``keys`` (which must
    be unique), as a range partitioning, a sort inside each partition and one
    offset per partition; nothing gathers in one task."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = written(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), name)
    sizes = part.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return part.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + inside - 1 + start).drop("_part", "_before")


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root``: for every node of ``edges(a, b)`` the smallest node
    reachable.  Alternates large-star and small-star steps until the edges
    stay the same; every step is a partially aggregated minimum and an equi-join
    (adaptive execution splits a hub's partition), its result a written table."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        nxt = written(small.select("e.a", "e.b").where("a <> b").distinct(), name)
        seen = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_written(now)
        now = nxt
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
