"""Data checks, freshness, usage guardrail and the daily report.

Every check returns one row ``(check_name, observed, threshold, passed,
detail)`` computed by a global aggregate, so the work is distributed and
only that row ever reaches the driver (and only when ``enforce`` asks).
Times are compared with an explicit ``as_of`` (UTC, TIMESTAMP_NTZ).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.functions.jsonpath import json_time_ntz
from barforge.functions.timefn import (clamp_window, day_start, minus_days, minus_minutes, minute_bucket,
                                       ntz_literal, seconds_between, utc_now)
from barforge.operators.silver import KEY, REQUIRED

CHECK_COLUMNS = ("check_name", "observed", "threshold", "passed", "detail")

# The thresholds used by the reference's scheduled checks.
MIN_RECENT_ROWS = 10
ACTIVITY_WINDOW_MINUTES = 5
BRONZE_WINDOW_MINUTES = 5
MAX_SILVER_LAG_SECONDS = 600
MAX_DAILY_CREDITS = 100.0
RUNNING = "RUNNING"

STATUS_SCHEMA = ("struct<name:string, connector:struct<state:string>,"
                 " tasks:array<struct<id:int, state:string>>>")


def as_of_col(as_of) -> Column:
    """``as_of`` given as text/datetime, as a Column, or None for UTC now."""
    if as_of is None:
        return utc_now()
    if isinstance(as_of, Column):
        return as_of
    return ntz_literal(as_of)


def _check(one_row: DataFrame, name: str, observed: Column, threshold: float | None,
           passed: Column, detail: Column) -> DataFrame:
    return one_row.select(
        F.lit(name).alias("check_name"),
        observed.cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        detail.alias("detail"),
    )


def _text(c: Column) -> Column:
    return c.cast("string")


def _ms_text(t: Column) -> Column:
    return F.coalesce(F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("none"))


def duplicate_key_groups(df: DataFrame, keys=KEY) -> DataFrame:
    """A5: number of key groups holding more than one row (one row: ``n``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
            .filter(F.col("_c") > 1).agg(F.count(F.lit(1)).alias("n")))


def only_if(df: DataFrame, gate: DataFrame) -> DataFrame:
    """``df`` if ``gate`` holds a row, else nothing: a semi-join with at most
    one row, so that adaptive execution, having run the gate, replaces ``df``
    by an empty relation and its scans never start."""
    return df.join(F.broadcast(gate.limit(1).select(F.lit(True).alias("_go"))), F.lit(True), "left_semi")


def repeated_blocks(df: DataFrame, partition: str = KEY[0], number: str = KEY[1]) -> DataFrame:
    """Blocks of ids that hold more rows than distinct ids, as ``(partition,
    _block)``: every block of 32,768 numbers is one exact bitmap, built before
    the exchange, so four kilobytes a block travel and not its keys.  (Ids
    that lie further apart than some 200 apiece make bitmaps the larger.)"""
    bits = df.groupBy(partition, F.bitmap_bucket_number(number).alias("_block")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number))).alias("_ids"))
    return bits.filter(F.col("_rows") > F.col("_ids")).select(partition, "_block")


def duplicate_groups_by_bitmap(df: DataFrame, partition: str = KEY[0], number: str = KEY[1]) -> DataFrame:
    """A5 over ``(partition, number)`` by bitmaps: rows of blocks with repeats
    are grouped by key; where no block has any, no key is exchanged at all.
    Null numbers set no bit, so a block that holds one is always grouped."""
    found = repeated_blocks(df, partition, number)
    keyed = only_if(df.select(partition, number), found).withColumn("_block", F.bitmap_bucket_number(number))
    again = keyed.alias("k").join(
        found.alias("b"), F.col(f"k.{partition}").eqNullSafe(F.col(f"b.{partition}")) & F.col("k._block").eqNullSafe(F.col("b._block")), "left_semi")
    return duplicate_key_groups(again, (partition, number))


def check_no_duplicates(silver: DataFrame, keys=KEY) -> DataFrame:
    """M1: fail when any (symbol, trade_id) occurs more than once.  A text and
    a number as keys are counted by bitmaps."""
    n = F.col("n")
    kinds = [silver.schema[k].dataType.simpleString() for k in keys]
    groups = duplicate_groups_by_bitmap(silver, *keys) if kinds == ["string", "bigint"] else duplicate_key_groups(silver, keys)
    return _check(groups, "silver_no_duplicates", n, 0.0,
                  n == 0, F.concat(F.lit("keys held by several rows: "), _text(n)))


def check_not_nulls(silver: DataFrame) -> DataFrame:
    """M2: fail when a row misses any of the five required fields."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED])
    agg = silver.filter(any_null).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return _check(agg, "silver_not_nulls", n, 0.0, n == 0,
                  F.concat(F.lit("rows with a missing required field: "), _text(n)))


def check_recent_activity(silver: DataFrame, as_of=None, min_rows: int = MIN_RECENT_ROWS,
                          window_minutes: int = ACTIVITY_WINDOW_MINUTES) -> DataFrame:
    """M3: rows with ``trade_time >= as_of - 5 min`` (no upper bound); fail below ``min_rows``.

    Written as filter-then-count so the time bound reaches the Parquet scan
    (row-group skipping on ``trade_time``).
    """
    start = minus_minutes(as_of_col(as_of), window_minutes)
    agg = silver.filter(F.col("trade_time") >= start).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return _check(agg, "silver_recent_activity", n, float(min_rows), n >= min_rows,
                  F.concat(F.lit(f"rows in last {window_minutes} min: "), _text(n)))


def bronze_trade_time(bronze: DataFrame, content: str = "record_content") -> Column:
    """Trade time of a raw row: the typed column the sink stores beside the
    payload, or, in rows from elsewhere, a safe parse (unparsable -> not counted)."""
    if "trade_time" in bronze.columns:
        return F.col("trade_time")
    return json_time_ntz(F.col(content), "T")


def recent_raw(bronze: DataFrame, start: Column) -> DataFrame:
    """Raw rows whose trade time is ``>= start``, as one column ``t``.  On the
    stored raw layer the bound reaches the scan of the typed column."""
    return bronze.select(bronze_trade_time(bronze).alias("t")).filter(F.col("t") >= start)


def check_bronze_recent(bronze: DataFrame, as_of=None,
                        window_minutes: int = BRONZE_WINDOW_MINUTES) -> DataFrame:
    """M4: count and latest trade time of raw rows in the last ``max(w,1)`` minutes;
    fail when there are none."""
    w = clamp_window(window_minutes)
    start = minus_minutes(as_of_col(as_of), w)
    t = recent_raw(bronze, start)
    agg = t.agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("latest"))
    n = F.col("n")
    return _check(agg, "bronze_recent_rows", n, 0.0, n > 0,
                  F.concat(F.lit(f"rows in last {w} min: "), _text(n),
                           F.lit(", latest trade time "), _ms_text(F.col("latest"))))


def check_silver_lag(silver: DataFrame, as_of=None,
                     max_lag_seconds: int = MAX_SILVER_LAG_SECONDS) -> DataFrame:
    """M5: ``datediff(second, max(ingested_at), as_of)``; fail when unknown or too high."""
    agg = silver.agg(F.max("ingested_at").alias("latest"))
    lag = seconds_between(F.col("latest"), as_of_col(as_of))
    return _check(agg, "silver_lag", lag, float(max_lag_seconds),
                  lag.isNotNull() & (lag <= max_lag_seconds),
                  F.concat(F.lit("silver lag seconds: "), F.coalesce(_text(lag), F.lit("unknown"))))


def _tagged_counts(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """Union of one-row counts tagged by name, folded into one wide row
    (no join needed)."""
    tagged = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(tag).alias("tag"), "n")
              for tag, df in parts]
    union = reduce(DataFrame.unionByName, tagged)
    return union.agg(*[F.sum(F.when(F.col("tag") == tag, F.col("n"))).cast("bigint").alias(tag)
                       for tag, _ in parts])


def daily_summary(bronze: DataFrame, silver: DataFrame, gold: DataFrame, as_of=None) -> DataFrame:
    """M6: rows of each layer in the last day (bronze by trade time, silver by
    trade time, gold by minute bucket) and the report text."""
    start = minus_days(as_of_col(as_of), 1)
    parts = [
        ("bronze_rows", recent_raw(bronze, start)),
        ("silver_rows", silver.filter(F.col("trade_time") >= start)),
        ("gold_buckets", gold.filter(F.col("minute_bucket") >= start)),
    ]
    wide = _tagged_counts(parts)
    return wide.select(
        "bronze_rows", "silver_rows", "gold_buckets",
        F.concat(F.lit("Daily summary (24h): bronze rows "), _text(F.col("bronze_rows")),
                 F.lit(", silver rows "), _text(F.col("silver_rows")),
                 F.lit(", gold 1m buckets "), _text(F.col("gold_buckets"))).alias("message"))


def check_daily_credits(metering: DataFrame, as_of, warehouse: str,
                        max_daily: float = MAX_DAILY_CREDITS) -> DataFrame:
    """M7: ``coalesce(sum(credits_used), 0)`` for one warehouse since the start
    of ``as_of``'s day (None: today, UTC); fail above ``max_daily``.  Summed as DECIMAL so the
    total does not depend on partition order."""
    start = day_start(as_of_col(as_of))
    agg = (metering.filter((F.col("warehouse_name") == warehouse) & (F.col("start_time") >= start))
           .agg(F.sum("credits_used").alias("s")))
    credits = F.coalesce(F.col("s"), F.lit(0).cast(agg.schema["s"].dataType))
    return _check(agg, "daily_credits", credits, float(max_daily),
                  credits.cast("double") <= max_daily,
                  F.concat(F.lit(f"credits since day start for {warehouse}: "), _text(credits)))


def check_pipeline_status(status: DataFrame, column: str = "status_json",
                          id_column: str | None = "doc_id") -> DataFrame:
    """M8: one check row per status document.

    Fails when the connector is not RUNNING, when the task list is missing
    or empty, or when any task is not RUNNING -- reported in that order.
    """
    doc = F.from_json(F.col(column), STATUS_SCHEMA)
    parsed = status.select(*([id_column] if id_column else []), doc.alias("d"))
    state = F.col("d.connector.state")
    tasks = F.col("d.tasks")
    # A missing list counts as empty (size(NULL) is -1 when ANSI is off).
    n_tasks = F.when(tasks.isNull(), F.lit(0)).otherwise(F.size(tasks))
    all_running = F.forall(tasks, lambda x: x["state"].eqNullSafe(RUNNING))
    first_bad = F.filter(tasks, lambda x: ~x["state"].eqNullSafe(RUNNING))[0]["state"]
    detail = (F.when(~state.eqNullSafe(RUNNING),
                     F.concat(F.lit("pipeline reports "), F.coalesce(state, F.lit("no state"))))
              .when(n_tasks == 0, F.lit("pipeline lists no task"))
              .when(~all_running, F.concat(F.lit("a task reports "),
                                           F.coalesce(first_bad, F.lit("no state"))))
              .otherwise(F.lit("pipeline and tasks up")))
    passed = state.eqNullSafe(RUNNING) & (n_tasks > 0) & F.coalesce(all_running, F.lit(False))
    return parsed.select(
        *([id_column] if id_column else []),
        F.lit("connector_status").alias("check_name"),
        n_tasks.cast("double").alias("observed"),
        F.lit(1.0).alias("threshold"),
        passed.alias("passed"),
        detail.alias("detail"),
    )


def latest_status(status: DataFrame, order_column: str = "doc_id",
                  column: str = "status_json") -> DataFrame:
    """The most recent status document (largest ``order_column``), one row."""
    return status.agg(F.max_by(F.col(column), F.col(order_column)).alias(column))


def run_suite(suite: str, checks: list[DataFrame]) -> DataFrame:
    """M9: ordered checks; rows after the first failure are marked ``skipped``
    (they are computed too, since all checks are one plan; ``enforce`` and
    ``failures`` act as if the suite had stopped there).

    The window is partitioned by suite name and holds one row per check, so
    it is bounded by the number of checks, not by data size.
    """
    rows = [c.select(F.lit(suite).alias("suite"), F.lit(i + 1).alias("ord"), *CHECK_COLUMNS)
            for i, c in enumerate(checks)]
    union = reduce(DataFrame.unionByName, rows)
    before = Window.partitionBy("suite").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    failed_before = F.coalesce(F.bool_or(~F.col("passed")).over(before), F.lit(False))
    return union.select("suite", "ord", *CHECK_COLUMNS, failed_before.alias("skipped"))


def run_until_failure(suite: str, checks: list[Callable[[Callable[[DataFrame], DataFrame]], DataFrame]]) -> DataFrame:
    """M9 with a short circuit: as ``run_suite``, but a check after a failure
    does no work.  Each check is made by a function that is given ``gate`` and
    puts it around the tables it reads; the gate lets rows through while the
    check before it passed.  What did not run is ``skipped``, with no
    observation and no verdict."""
    rows: list[DataFrame] = []
    passing: DataFrame | None = None
    for i, make in enumerate(checks):
        gate = (lambda df: df) if passing is None else (lambda df, on=passing: only_if(df, on))
        row = make(gate).select(F.lit(suite).alias("suite"), F.lit(i + 1).alias("ord"), *CHECK_COLUMNS)
        if passing is None:
            row = row.withColumn("skipped", F.lit(False))
        else:
            # The check's row and the verdict before it meet in one group of two rows.
            held = passing.agg(F.count(F.lit(1)).alias("_held")).select(*[F.lit(None).cast(row.schema[c].dataType).alias(c) for c in row.columns if c != "ord"],
                                                                         F.lit(i + 1).alias("ord"), "_held")
            both = row.withColumn("_held", F.lit(None).cast("bigint")).unionByName(held)
            met = both.groupBy("ord").agg(*[F.max(c).alias(c) for c in ("suite", *CHECK_COLUMNS, "_held")])
            ran = F.col("_held") > 0
            row = met.select("suite", "ord", "check_name", F.when(ran, F.col("observed")).alias("observed"), "threshold", F.when(ran, F.col("passed")).alias("passed"),
                             F.when(ran, F.col("detail")).otherwise(F.lit("not run")).alias("detail"), (~ran).alias("skipped"))
        rows.append(row)
        passing = row.filter(F.col("passed")).select("ord")
    return reduce(DataFrame.unionByName, rows)


def quality_until_failure(silver: DataFrame, as_of=None, min_rows: int = MIN_RECENT_ROWS) -> DataFrame:
    """The quality order, stopping at the first failure."""
    return run_until_failure("data_quality", [lambda gate: check_not_nulls(gate(silver)), lambda gate: check_no_duplicates(gate(silver)),
                                              lambda gate: check_recent_activity(gate(silver), as_of, min_rows)])


def health_until_failure(status: DataFrame, bronze: DataFrame, silver: DataFrame, as_of=None,
                         window_minutes: int = BRONZE_WINDOW_MINUTES, max_lag_seconds: int = MAX_SILVER_LAG_SECONDS) -> DataFrame:
    """The health order, stopping at the first failure."""
    return run_until_failure("healthcheck", [lambda gate: check_pipeline_status(latest_status(status), id_column=None),
                                             lambda gate: check_bronze_recent(gate(bronze), as_of, window_minutes),
                                             lambda gate: check_silver_lag(gate(silver), as_of, max_lag_seconds)])


def quality_suite(silver: DataFrame, as_of=None, min_rows: int = MIN_RECENT_ROWS) -> DataFrame:
    """Quality order: nulls -> duplicates -> recent activity."""
    return run_suite("data_quality", [check_not_nulls(silver), check_no_duplicates(silver),
                                      check_recent_activity(silver, as_of, min_rows)])


def health_suite(status: DataFrame, bronze: DataFrame, silver: DataFrame, as_of=None,
                 window_minutes: int = BRONZE_WINDOW_MINUTES,
                 max_lag_seconds: int = MAX_SILVER_LAG_SECONDS) -> DataFrame:
    """Health order: pipeline status -> bronze recency -> silver lag."""
    status_row = check_pipeline_status(latest_status(status), id_column=None)
    return run_suite("healthcheck", [status_row,
                                     check_bronze_recent(bronze, as_of, window_minutes),
                                     check_silver_lag(silver, as_of, max_lag_seconds)])


def failures(results: DataFrame, run_id: str, log_root: str = "") -> DataFrame:
    """Failure records (suite, task, run, error, log link) for checks that
    ran and failed; the link names the task's log under ``log_root``."""
    ran = ~F.col("skipped") if "skipped" in results.columns else F.lit(True)
    return results.filter(~F.col("passed") & ran).select(
        F.col("suite"), F.col("check_name").alias("task"), F.lit(run_id).alias("run_id"),
        F.col("detail").alias("error"),
        F.concat_ws("/", F.lit(log_root.rstrip("/")), F.col("suite"), F.col("check_name"),
                    F.lit(run_id)).alias("log_link"))


def record_failures(failed: DataFrame, path: str) -> None:
    """Append failure records to the alerts table (the chat post, re-aimed)."""
    failed.write.mode("append").parquet(path)


def count_where(df: DataFrame, predicate: Column, name: str = "n") -> DataFrame:
    """One-row count of the rows matching ``predicate`` (filter first, so
    the predicate can reach the scan)."""
    return df.filter(predicate).agg(F.count(F.lit(1)).alias(name))


def layer_lag(bronze: DataFrame, silver: DataFrame, gold: DataFrame, as_of=None) -> DataFrame:
    """Newest time of each layer and its distance to ``as_of`` in seconds."""
    return _lags(bronze.select(bronze_trade_time(bronze).alias("t")), silver.select(F.col("ingested_at").alias("t")),
                 gold.select(F.col("minute_bucket").alias("t")), as_of)


def _lags(bronze: DataFrame, silver: DataFrame, gold: DataFrame, as_of) -> DataFrame:
    now = as_of_col(as_of)
    parts = [df.select(F.lit(name).alias("layer"), "t") for name, df in (("bronze", bronze), ("silver", silver), ("gold", gold))]
    latest = reduce(DataFrame.unionByName, parts).groupBy("layer").agg(F.max("t").alias("t"))
    wide = latest.agg(*[F.max(F.when(F.col("layer") == x, F.col("t"))).alias(f"{x}_latest")
                        for x in ("bronze", "silver", "gold")])
    return wide.select(
        "bronze_latest", "silver_latest", "gold_latest",
        *[seconds_between(F.col(f"{x}_latest"), now).alias(f"{x}_lag_seconds")
          for x in ("bronze", "silver", "gold")])


def ledger_minutes(ledger: DataFrame) -> DataFrame:
    """Minutes that hold trades, with their number: what all batches together
    did to each (``minute_bucket, trades``)."""
    return (ledger.filter(F.col("minute_bucket").isNotNull()).groupBy("minute_bucket").agg(F.sum("trades").alias("trades"))
            .filter(F.col("trades") > 0))


def ledger_layer_lag(ledger: DataFrame, as_of=None) -> DataFrame:
    """M11 from the maintenance ledger alone (``storage.read_ledger``)."""
    return _lags(ledger.select(F.col("last_raw").alias("t")), ledger.select(F.col("last_ingested").alias("t")),
                 ledger_minutes(ledger).select(F.col("minute_bucket").alias("t")), as_of)


def ledger_silver_lag(ledger: DataFrame, as_of=None, max_lag_seconds: int = MAX_SILVER_LAG_SECONDS) -> DataFrame:
    """M5 from the maintenance ledger alone.  A trade is only ever replaced by
    a copy ingested no earlier, so the latest ingest of any batch's winners is
    silver's."""
    return check_silver_lag(ledger.select(F.col("last_ingested").alias("ingested_at")), as_of, max_lag_seconds)


def ledger_recent_activity(ledger: DataFrame, silver: DataFrame, as_of=None, min_rows: int = MIN_RECENT_ROWS,
                           window_minutes: int = ACTIVITY_WINDOW_MINUTES) -> DataFrame:
    """M3 from the ledger: whole minutes are counted there, and silver is read
    for the part of a minute at the window's beginning only."""
    start = minus_minutes(as_of_col(as_of), window_minutes)
    whole = F.when(minute_bucket(start) == start, start).otherwise(minus_minutes(minute_bucket(start), -1))
    minutes = ledger_minutes(ledger).filter(F.col("minute_bucket") >= whole).select("trades")
    edge = silver.filter((F.col("trade_time") >= start) & (F.col("trade_time") < whole)).agg(F.count(F.lit(1)).alias("trades"))
    agg = minutes.unionByName(edge).agg(F.sum("trades").alias("n"))
    n = F.col("n")
    return _check(agg, "silver_recent_activity", n, float(min_rows), n >= min_rows,
                  F.concat(F.lit(f"rows in last {window_minutes} min: "), _text(n)))


def enforce(results: DataFrame) -> DataFrame:
    """Raise like the reference when a check that ran has failed.

    Collects only the check rows (one per check), never table data.
    """
    ran = ~F.col("skipped") if "skipped" in results.columns else F.lit(True)
    bad = results.filter(~F.col("passed") & ran).select("check_name", "detail").collect()
    if bad:
        raise RuntimeError("; ".join(f"{r.check_name}: {r.detail}" for r in bad))
    return results
