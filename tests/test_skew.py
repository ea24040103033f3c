"""One key, store and region hold a third of all rows; results stay whole."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates, dedup, quality

ROWS = 90_000
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    is_hot = F.col("id") % 3 == 0
    at = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))
    return spark.range(ROWS, numPartitions=16).select(
        F.when(is_hot, -1).otherwise(F.col("id")).alias("sale_id"),
        F.when(is_hot, "S0").otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("store_id"),
        F.when(is_hot, "A").otherwise("B").alias("region"),
        (F.col("id") % 1000).cast("string").alias("customer_id"),
        F.lit("2.00").cast("decimal(10,2)").alias("total_amount"),
        at.alias("sale_date"),
        at.alias("updated_at"),
    )


def test_latest_row_of_a_hot_key(hot):
    latest = dedup.latest_live_row(hot)
    assert latest.count() == ROWS * 2 // 3 + 1
    newest = latest.filter("sale_id = -1").first()
    assert newest.updated_at == T0 + dt.timedelta(seconds=ROWS - 3)


def test_hot_region_and_store(hot):
    regions = {r.region_name: (r.total_transactions, r.customer_count) for r in aggregates.dim_regions(hot, T0).collect()}
    assert regions == {"A": (30_000, 1000), "B": (60_000, 1000)}
    known = hot.sparkSession.createDataFrame([("S1",)], "store_id string")
    orphans = quality.orphan_keys(hot, known, "store_id")
    assert orphans.agg(F.sum("orphan_count")).first()[0] == ROWS - hot.filter("store_id = 'S1'").count()
