"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash.  A source's target is some number of
whole passes over it plus a rest; the rest is the set of documents whose hash
lies under the source's threshold.  The threshold is found without sorting:
tokens are summed by source and hash cell, the cell in which the budget ends
is found from the cells' running sums, and only that boundary cell is split
into finer cells, until it holds one hash value.  A larger budget has a larger
threshold, so the chosen sets are nested, and reruns choose the same rows.

Defined results: a null text has size 0; null sources form one group of their
own, after all others; a source without words has target 0 and takes nothing;
repeated rows (same id) share one hash and are taken or left together; rows
without an id are told apart by their texts, so only copies of one text among
them go together; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import global_rank, written

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
CELL_BITS = 10
#: A source is passed over at most so many times.
MAX_EPOCHS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(key: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id, or of the text where there is no id, as a
    long from 0."""
    named = F.coalesce(key.cast("string"), F.concat(F.lit("null:"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], max_epochs: int) -> DataFrame:
    """``source, source_size, target`` from one row per source: shares of the
    whole by weight (repeating in the order of ``source``, null last), none
    above ``max_epochs`` times its source, the excess reshared by weight.
    Each round is one aggregate of three numbers."""
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    ordered = sizes.withColumn("_null", F.col("source").isNull())
    ranked = global_rank(ordered, ["_null", "source"], "_k", "mix-sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    ranked = written(ranked.select("source", "source_size", w.alias("_w")), "mix-weights")
    cap = F.col("source_size") * float(max_epochs)
    level, capped = 0.0, -1
    while True:
        over = cap <= F.col("_w") * F.lit(level)
        row = ranked.agg(F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("_w"))), F.sum(over.cast("long"))).first()
        if row[2] is None or row[2] == capped or not row[1]:
            break
        capped = row[2]
        level = max(level, (float(total) - row[0]) / row[1])
    target = F.when(cap <= F.col("_w") * F.lit(level), cap).otherwise(F.col("_w") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, _below``: the rest budget of a source is met nearest by its
    rows with ``_hash`` < ``_below``.  ``rows``: source, _hash, size;
    ``budgets``: source, _rest."""
    open_cells = budgets.select("source", F.col("_rest"), F.lit(0).cast("long").alias("_cell"))
    found = None
    shift = HASH_BITS
    while True:
        shift -= CELL_BITS
        cells = (rows.withColumn("_up", F.shiftright("_hash", shift + CELL_BITS))
                 .join(open_cells.withColumnsRenamed({"source": "_s", "_cell": "_up2"}),
                       F.col("source").eqNullSafe(F.col("_s")) & (F.col("_up") == F.col("_up2")))
                 .groupBy("source", "_rest", F.shiftright("_hash", shift).alias("_cell"))
                 .agg(F.sum("size").alias("_size"), F.min("_hash").alias("_lo"), F.max("_hash").alias("_hi")))
        run = F.sum("_size").over(Window.partitionBy("source").orderBy("_cell"))
        ends = (cells.withColumn("_run", run).where("_run >= _rest")
                .groupBy("source", "_rest").agg(F.min(F.struct("_cell", "_run", "_size", "_lo", "_hi")).alias("e"))
                .select("source", "_rest", "e.*"))
        ends = written(ends, "mix-ends")
        done = ends.where("_lo = _hi").select(
            "source", (F.col("_hi") + F.when(F.col("_run") - F.col("_rest") <= F.col("_rest") - F.col("_run") + F.col("_size"), 1).otherwise(0)).alias("_below"))
        found = done if found is None else found.unionByName(done)
        open_cells = ends.where("_lo < _hi").select("source", (F.col("_rest") - F.col("_run") + F.col("_size")).alias("_rest"), "_cell")
        if open_cells.isEmpty():
            return found


def mix_plan(docs: DataFrame, weights: list[float], id_col: str, text_col: str, source_col: str, max_epochs: int) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes and hashes (written), and per source its size,
    target, whole passes and threshold."""
    rows = written(docs.select(docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"),
                               row_hash(docs[id_col], docs[text_col]).alias("_hash"), n_words(docs[text_col]).alias("size")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    targets = written(source_targets(sizes, weights, max_epochs), "mix-targets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("_passes", passes).withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size"))
    below = thresholds(rows, targets.where("_rest > 0").select("source", "_rest"))
    plan = targets.join(below.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return rows, written(plan.withColumnRenamed("source", "_source"), "mix-plan")


def times_taken(hashed: Column) -> Column:
    return F.col("_passes") + F.coalesce(hashed < F.col("_below"), F.lit(False)).cast("long")


def mix_sources(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``doc_id, size, source, source_size, target, taken``: ``taken`` counts
    the words the mix takes of a document, whole passes included."""
    rows, plan = mix_plan(docs, weights, id_col, text_col, source_col, max_epochs)
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source", "source_size", "target", (F.col("size") * times_taken(F.col("_hash"))).alias("taken"))


def repeat_taken(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source", max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken.  Only the
    sources' plan is joined; texts are not shuffled."""
    _, plan = mix_plan(docs, weights, id_col, text_col, source_col, max_epochs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[source_col].cast("string").alias("s"), row_hash(docs[id_col], docs[text_col]).alias("h"))
    taken = rows.join(plan, F.col("s").eqNullSafe(F.col("_source"))).withColumn("times", times_taken(F.col("h")).cast("int")).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*[F.col("row")[c].alias(c) for c in docs.columns])


#: DuckDB twin of the query (weights 1, 2, 3 repeating; whole passes and rest).
MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null:' || coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM {docs}),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS n,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM d GROUP BY source),
lv AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS level
  UNION ALL
  SELECT lv.i + 1, (SELECT (sum(n) - sum(CASE WHEN 3 * n <= w * lv.level THEN 3 * n ELSE 0 END))
                          / nullif(sum(CASE WHEN 3 * n <= w * lv.level THEN 0 ELSE w END), 0) FROM s)
  FROM lv WHERE lv.i < 60),
t AS (SELECT source, n, least(3 * n, w * (SELECT max(level) FROM lv)) AS target FROM s),
u AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS passes FROM t),
g AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
c AS (SELECT source, h, size, sum(size) OVER (PARTITION BY source ORDER BY h) AS run FROM g),
e AS (SELECT c.source, min({{'h': h, 'over': run - (target - passes * n), 'under': (target - passes * n) - run + size}}) AS e
      FROM c JOIN u ON c.source IS NOT DISTINCT FROM u.source
      WHERE target - passes * n > 0 AND run >= target - passes * n GROUP BY c.source),
b AS (SELECT source, e.h + CASE WHEN e.over <= e.under THEN 1 ELSE 0 END AS below FROM e)
SELECT {cols} FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""


def mix_sql(docs: str = "documents") -> str:
    return MIX_SQL.format(docs=docs, cols=(
        "d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(u.n AS BIGINT) AS source_size, u.target, "
        "CAST(d.size * (u.passes + CASE WHEN coalesce(d.h < b.below, false) THEN 1 ELSE 0 END) AS BIGINT) AS taken"))
