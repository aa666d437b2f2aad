"""Session helpers: the configuration every job in this package expects.

Operators never change global configuration themselves.  They use
zone-proof expressions (see ``barforge.functions.timefn``) so results do not
depend on the session time zone; the builder below still pins UTC so that
printed timestamps read the same everywhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "barforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the pipeline relies on.

    On a cluster pass ``master=None`` and let spark-submit decide.  The
    shuffle partition count defaults to the number of local cores for local
    masters; on a cluster AQE coalesces from the configured value.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Extract only the VARIANT paths a plan reads, once, inside the
        # Parquet scan (2.3x faster raw -> silver measured at 896k rows).
        "spark.sql.variant.pushVariantIntoScan": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint directory, whatever the
    file system: Spark and the Hadoop file system make it when it is written.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we read
    it from the session.  Only where it is unset, on a local master (tests,
    benches), a folder of this application under the JVM's temporary
    directory takes its place.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = f"file://{sc._jvm.System.getProperty('java.io.tmpdir')}/barforge-{sc.applicationId}"
    return "/".join([root.rstrip("/"), *parts])


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the shared directory (one per run)."""
    return shared_dir(spark, "runs", f"{name}-{uuid.uuid4().hex}")


def written_table(df, name: str):
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage the way a stored table does: later plans scan the files
    (with pruning and pushdown) instead of recomputing ``df``, and an
    executor loss cannot lose it.
    """
    path = fresh_dir(df.sparkSession, name) + "/data"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
