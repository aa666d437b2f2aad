"""Plan shape: de-dup pruned map-side, two exchanges from raw to bars,
no Python in any registered batch plan, filters and columns pushed to scans."""

import os
import re

import pytest
from conftest import SF_SMALL

from barforge.operators import checks
from barforge.operators.gold import gold_trades_1m
from barforge.operators.silver import silver_trades
from barforge.plans.catalog import QUERIES
from barforge.session import fresh_dir
from barforge.sources import fixtures
from barforge.sources.topic import read_bronze
from barforge.streaming import storage as stg

STREAMING = {"bronze_ingest", "ingest_rejects", "late_settled_bars", "silver_incremental", "gold_incremental", "backfill_gold",
             "recover_gold", "stream_bars_append", "stream_bars_update", "registered_layers", "ingest_to_gold", "ledger_layer_lag", "ledger_checks"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_bronze(spark):
    path = os.path.join(fresh_dir(spark, "plans"), "bronze")
    fixtures.bronze_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")) \
        .write.parquet(path)
    return read_bronze(spark, path)


def test_dedup_is_pruned_before_the_shuffle(spark, stored_bronze):
    p = plan(silver_trades(stored_bronze))
    assert p.count("WindowGroupLimit") == 2          # partial (map side) + final


def test_two_exchanges_from_raw_rows_to_bars(spark, stored_bronze):
    p = plan(gold_trades_1m(silver_trades(stored_bronze)))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2
    assert "HashAggregate" in p and "SortAggregate" not in p


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_python_in_batch_plans(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas", p)


def test_time_filter_and_columns_reach_the_scan(spark, stored_bronze):
    root = fresh_dir(spark, "plans-silver")
    layout = stg.Layout(root)
    stg.with_block(silver_trades(stored_bronze), layout.id_block_size) \
        .write.partitionBy(*stg.SILVER_PARTS).parquet(layout.silver)
    df = checks.check_recent_activity(stg.read_silver(spark, layout), "2024-01-01 12:00:00")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*trade_time", p)
    assert re.search(r"ReadSchema: struct<trade_time:timestamp_ntz>", p)
