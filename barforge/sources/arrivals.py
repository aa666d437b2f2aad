"""Raw files that arrive part by part in a watched folder (test and bench
harness for the streaming plans).

All parts are written by one Spark job; a part then *arrives* by an atomic
directory rename into the folder a file-source stream watches, the way
upstream writers publish finished files.  One long-running query catches up
after each arrival (``processAllAvailable``), so each part is seen whole.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from barforge.sources.topic import RAW_SCHEMA
from barforge.streaming import storage as st


class Arrivals:
    def __init__(self, spark: SparkSession, tagged: DataFrame, root: str,
                 schema: str = RAW_SCHEMA, part_column: str = "part"):
        self.spark = spark
        self.schema = schema
        self.staged = os.path.join(root, "_arrivals")
        self.folder = os.path.join(root, "raw")
        tagged.write.partitionBy(part_column).parquet(self.staged)
        st.mkdirs(spark, self.folder)
        self.part_column = part_column

    def deliver(self, part: int) -> None:
        src = os.path.join(self.staged, f"{self.part_column}={part}")
        if st.exists(self.spark, src):
            st.rename(self.spark, src, os.path.join(self.folder, f"arrival-{part}"))

    def stream(self) -> DataFrame:
        return (self.spark.readStream.schema(self.schema)
                .option("recursiveFileLookup", "true").parquet(self.folder))

    def read(self) -> DataFrame:
        return (self.spark.read.schema(self.schema)
                .option("recursiveFileLookup", "true").parquet(self.folder))
