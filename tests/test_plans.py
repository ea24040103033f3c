"""Plans that must hold at scale."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_TINY
from tidemark.operators import aggregates, dedup, gate, quality, staging
from tidemark.plans import catalog, inputs, row_queries, stream_queries, table_queries
from tidemark.sources.extract import extract_window
from tidemark.sources.tables import table

# Queries that write and read tables before they return.
STORING = {name for module in (table_queries, stream_queries) for name in vars(module)}
LAZY = sorted(name for name in catalog.QUERIES if name not in STORING)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF_TINY))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in text


def test_latest_row_limits_groups_before_the_shuffle(spark):
    text = plan(dedup.latest_live_row(staging.split_live(inputs.sales(spark, SF_TINY))))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Partial") > text.index("Exchange hashpartitioning(sale_id")


def test_extract_conditions_reach_the_scan(spark):
    source = table(spark, SF_TINY, "lineitem").withColumnRenamed("l_shipdate", "updated_at").withColumn("status", F.lit("completed"))
    for name, kind in (("sale_id", "bigint"), ("is_deleted", "boolean")):
        source = source.withColumn(name, F.lit(None).cast(kind))
    missing = set(row_queries.SOURCE_COLUMNS) - set(source.columns)
    source = source.withColumns({name: F.lit(None).cast("string") for name in missing})
    text = plan(extract_window(source, dt.date(1998, 6, 2)))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in text


def test_daily_sales_hashes(spark):
    text = plan(aggregates.daily_sales(inputs.fact(spark, SF_TINY), inputs.AS_OF))
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_merge_reuses_the_deduplication_shuffle(spark):
    from tidemark.operators.merge import cdc_merge

    text = plan(cdc_merge(inputs.old_fact(spark, SF_TINY), inputs.changes(spark, SF_TINY), inputs.AS_OF))
    join = text[text.index("FullOuter"):]
    assert "Exchange" not in join[: join.index("Window")]


def test_row_tests_share_one_scan(spark):
    df = table(spark, SF_TINY, "orders")
    tests = [quality.not_null(c) for c in ("o_orderkey", "o_custkey", "o_orderdate")]
    assert plan(quality.row_test_results(df, tests)).count("FileScan") == 1


def test_counts_read_their_input_once(spark):
    for name, scans in (("extraction_counts", 7), ("batch_decisions", None)):
        text = plan(catalog.QUERIES[name](spark, SF_TINY))
        assert scans is None or text.count("FileScan") == scans
    changes = inputs.changes(spark, SF_TINY)
    assert "FullOuter" not in plan(gate.reconcile_load(changes, changes.withColumn("_merge_action", F.lit("insert"))))


def test_batch_scan_prunes(spark):
    assert "PartitionFilters: [isnotnull(etl_batch_id" in plan(catalog.QUERIES["batch_scan"](spark, SF_TINY))


def test_gate_builds_the_fact_once_and_moves_no_rows_by_batch(spark):
    text = plan(catalog.QUERIES["gate_admitted_rows"](spark, SF_TINY))
    assert "Window" not in text and "SortMergeJoin" not in text
    assert "Exchange hashpartitioning" not in text and text.count("FileScan") == 2
