"""Measure what an incremental batch costs: against the size of the table, and
against the number of silver blocks it touches.

Silver/gold are rebuilt at 1x, 4x and 8x the sf0.1 trades (trade ids offset
per replica), then the same batch of new trades is applied to each.  Then the
same batch is applied to layouts of smaller and smaller blocks.

usage: python tests/scale_probe.py
"""

import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from barforge.session import build_session, fresh_dir  # noqa: E402
from barforge.sources import fixtures  # noqa: E402
from barforge.streaming import maintain as mt  # noqa: E402
from barforge.streaming import storage as stg  # noqa: E402

spark = build_session("local[8]", shuffle_partitions=8)



def replica(events, k):
    """The derived trades with trade ids shifted by k * 10^7."""
    m = fixtures.trade_messages(events)
    c = F.expr("regexp_replace(content, '\"t\":[0-9]+', concat('\"t\":', cast(cast(regexp_extract("
               f"content, '\"t\":([0-9]+)', 1) as bigint) + {k} * 10000000 as string)))")
    return m.select(F.parse_json("metadata").alias("record_metadata"),
                    F.parse_json(c).alias("record_content"))


big = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
small = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
for reps in [1, 4, 8]:
    layout = stg.Layout(os.path.join(fresh_dir(spark, "scale"), "t"))
    stg.bootstrap_layers(spark, layout)
    root = fresh_dir(spark, "scalebronze")
    reduce(DataFrame.unionByName, [replica(big, k) for k in range(reps)]).write.parquet(root + "/b")
    t = time.time()
    mt.rebuild(spark.read.parquet(root + "/b"), layout)
    rb = time.time() - t
    n = stg.read_silver(spark, layout).count()
    replica(small, 50).write.parquet(root + "/new")
    times = []
    for i in range(2):
        batch = spark.read.parquet(root + "/new")
        t = time.time()
        mt.upsert_batch(batch, i, layout, "s")
        times.append(round(time.time() - t, 2))
    print(f"silver rows {n}: rebuild {rb:.1f}s, same 11k-row batch of new trades: {times} s",
          flush=True)

for block in [10_000, 500, 25]:
    layout = stg.Layout(os.path.join(fresh_dir(spark, "blocks"), "t"), block)
    stg.bootstrap_layers(spark, layout)
    root = fresh_dir(spark, "blocksbronze")
    replica(small, 50).write.parquet(root + "/new")
    times = []
    for i in range(2):      # new trades are appended; the same rows again replace them
        t = time.time()
        mt.upsert_batch(spark.read.parquet(root + "/new"), i, layout, "s")
        times.append(round(time.time() - t, 2))
    n = len(stg.staged_partitions(spark, stg.live(spark, layout).silver))
    print(f"touched blocks {n}: append, rewrite {times} s", flush=True)
