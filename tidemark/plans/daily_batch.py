"""The daily batch from regional extracts to verified tables.

Every step reads what the step before it stored, so a run that stops can be
started again for the same day: slices and exports replace what an earlier
attempt left behind, and the merge acts on the fact as it is then.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import batch_window
from tidemark.operators import aggregates, enrich, gate, quality, staging
from tidemark.operators.dedup import latest_change_per_key
from tidemark.schemas import EXTRACT_COLUMNS, MAX_FAILING_PERCENTAGE, MIN_RECORD_COUNT, STAGE_COLUMNS, conform, schema_of
from tidemark.session import written
from tidemark.sinks import csv_export, fact_table, partitions
from tidemark.sources import extract, files

EXPORT_COLUMNS = [name for name in STAGE_COLUMNS if name != "_kafka_offset"]


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of one warehouse lie, and how many key buckets its fact gets."""

    root: str
    buckets: int = 1

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


@dataclass
class BatchResult:
    """What a run decided and did; every frame has one row or a handful.

    ``loaded`` says whether live rows entered the fact. A batch of which only
    the deletes were applied has a tally all the same.
    """

    batch_id: str
    decision: DataFrame
    loaded: bool
    tally: DataFrame | None = None
    verification: DataFrame | None = None
    tests: DataFrame | None = None


def run_daily_batch(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    warehouse: Warehouse,
    as_of: dt.date,
    labels: Mapping[str, str],
    min_records: int = MIN_RECORD_COUNT,
    max_failing_percentage: float = MAX_FAILING_PERCENTAGE,
) -> BatchResult:
    """Extract one day from all regions, check it, and merge it into the warehouse."""
    batch_id = batch_window(as_of).batch_id
    loaded_at = dt.datetime(as_of.year, as_of.month, as_of.day)

    extracted = extract.extract_regions(sources, as_of)
    partitions.replace_run(extracted, warehouse.path("raw_extract"), "etl_batch_id", batch_id, ["region"])
    raw = _slice(spark, warehouse.path("raw_extract"), EXTRACT_COLUMNS, batch_id)

    # Rows that break a rule are set aside one by one; the gate judges the batch
    # before that, so that what is wrong with all of it shows.
    live = staging.transform_live(raw, loaded_at, batch_id, dict(labels))
    checked = written(enrich.with_reason(enrich.enrich(live)), "checked")
    partitions.replace_run(
        enrich.quarantined(checked), warehouse.path("quarantine"), "etl_batch_id", batch_id, ["validation_failure_reason"]
    )
    markers = staging.stamp_load(
        staging.normalise_region(staging.split_deleted(raw), dict(labels)), loaded_at, batch_id
    )
    good = enrich.passed(checked).drop("is_amount_valid", "validation_failure_reason")
    due = spark.createDataFrame([(batch_id,)], "etl_batch_id string")
    decision = written(gate.batch_decisions(due, checked, markers, min_records, max_failing_percentage=max_failing_percentage), "decision")
    decided = decision.select("decision").first().decision
    if decided not in (gate.LOAD, gate.DELETES_ONLY):
        return BatchResult(batch_id, decision, loaded=False)
    if decided == gate.DELETES_ONLY:
        good = good.limit(0)

    both = conform(staging.union_live_and_markers(good, markers), EXPORT_COLUMNS)
    export = csv_export.export_path(warehouse.path("export"), as_of, batch_id)
    csv_export.export_csv(both, export, EXPORT_COLUMNS)
    partitions.rebuild(files.read_stage_csv(spark, export, schema_of(EXPORT_COLUMNS)), warehouse.path("stage"))
    staged = spark.read.schema(schema_of(EXPORT_COLUMNS)).parquet(warehouse.path("stage"))

    changes = latest_change_per_key(staged)
    fact_path = warehouse.path("fact")
    tally = fact_table.merge_into_fact(
        spark, fact_path, changes, loaded_at, f"batch-{batch_id}", buckets=warehouse.buckets, daily=True, history=True
    )
    fact = fact_table.read_fact(spark, fact_path)
    tests = build_models(spark, fact, warehouse, loaded_at, list(labels.values()))
    verification = verify_load(changes, fact, batch_id)
    # Stored, because the next run replaces the files they are computed from.
    return BatchResult(
        batch_id, decision, decided == gate.LOAD, written(tally, "tally"), written(verification, "verification"), written(tests, "tests")
    )


def _slice(spark: SparkSession, path: str, columns: list[str], batch_id: str) -> DataFrame:
    return spark.read.schema(schema_of(columns)).parquet(path).filter(F.col("etl_batch_id") == batch_id).select(*columns)


def build_models(
    spark: SparkSession, fact: DataFrame, warehouse: Warehouse, as_of: dt.datetime, regions: list[str]
) -> DataFrame:
    """Rebuild the dimensions and test the fact; daily KPIs and history are kept by the merge."""
    partitions.rebuild(aggregates.dim_regions(fact, as_of), warehouse.path("dim_regions"))
    partitions.rebuild(aggregates.dim_stores(fact, as_of), warehouse.path("dim_stores"))
    stores = spark.read.parquet(warehouse.path("dim_stores"))
    rows = [
        *[quality.not_null(name) for name in ("sale_id", "customer_id", "store_id", "sale_date", "region")],
        *[quality.not_null(name, quality.WARN) for name in ("net_amount", "gross_profit")],
        quality.accepted_values("region", regions),
    ]
    return quality.run_tests(fact, rows, [("sale_id", quality.ERROR)], [("store_id", stores, quality.WARN)])


def verify_load(changes: DataFrame, fact: DataFrame, batch_id: str) -> DataFrame:
    """Expected against loaded rows and duplicate keys of one batch."""
    expected = changes.agg(F.count_if(~F.col("is_deleted")).alias("expected_count"))
    in_batch = fact.filter(F.col("etl_batch_id") == batch_id).groupBy("sale_id").agg(F.count(F.lit(1)).alias("n"))
    actual = in_batch.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("actual_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_count"),
    )
    both = expected.select(
        F.lit(batch_id).alias("batch_id"),
        "expected_count",
        *[actual.select(name).scalar().alias(name) for name in actual.columns],
    )
    good = (F.col("expected_count") == F.col("actual_count")) & (F.col("duplicate_count") == 0)
    return both.withColumn("status", F.when(good, "success").otherwise("mismatch"))
