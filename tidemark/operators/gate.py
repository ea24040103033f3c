"""Batch gate, batch metrics and load reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import violates_business_rules
from tidemark.operators.merge import ACTION
from tidemark.operators.quality import missing_columns
from tidemark.schemas import CRITICAL_COLUMNS, MAX_FAILING_PERCENTAGE, MAX_NULL_PERCENTAGE, MIN_RECORD_COUNT, REQUIRED_COLUMNS

LOAD, STOP = "load", "quarantine"
# Decisions about batches without enough live rows: only their delete markers are applied, or there is nothing to do.
DELETES_ONLY, NO_DATA = "deletes_only", "no_data"


def null_counts(columns: Sequence[str] = tuple(CRITICAL_COLUMNS)) -> list[Column]:
    """One null count per column."""
    return [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns]


def _percentage(part: str) -> Column:
    whole = F.nullif(F.col("total_records"), F.lit(0))
    return F.coalesce(F.col(part).cast("decimal(18,0)") * 100 / whole, F.lit(0)).cast("decimal(18,2)")


def null_profile(df: DataFrame, columns: Sequence[str] = tuple(CRITICAL_COLUMNS)) -> DataFrame:
    """Row count, null counts and null percentages in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("total_records"), *null_counts(columns))
    return counted.withColumns({f"null_pct_{name}": _percentage(f"null_{name}") for name in columns})


def rule_violations(df: DataFrame) -> DataFrame:
    """Rows that break a business rule, per batch."""
    return df.groupBy("etl_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(violates_business_rules()).alias("invalid_records"),
    )


def batch_gate(
    df: DataFrame,
    min_records: int = MIN_RECORD_COUNT,
    max_null_percentage: float = MAX_NULL_PERCENTAGE,
    critical: Sequence[str] = tuple(CRITICAL_COLUMNS),
    required: Sequence[str] = tuple(REQUIRED_COLUMNS),
) -> DataFrame:
    """Decide per batch whether its live rows may be loaded, and why not.

    One aggregation pass counts rows, NULLs and rule violations; the first
    failed check, in that order, is the reason. Missing columns fail at once.
    """
    absent = missing_columns(df, required)
    if absent:
        reason = "missing columns: " + ", ".join(absent)
        return df.select("etl_batch_id").distinct().select(
            "etl_batch_id",
            F.lit(None).cast("bigint").alias("total_records"),
            F.lit(None).cast("bigint").alias("invalid_records"),
            F.lit(STOP).alias("decision"),
            F.lit(reason).alias("failure_reason"),
        )
    checked = df.groupBy("etl_batch_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        *null_counts(critical),
        F.count_if(violates_business_rules()).alias("invalid_records"),
    )
    limit = F.lit(Decimal(str(max_null_percentage)))
    total = F.col("total_records")
    reasons = [F.when(total < min_records, F.concat(F.lit("too few records: "), total.cast("string")))]
    for name in critical:
        nulls = F.col(f"null_{name}")
        reasons.append(
            F.when(
                nulls.cast("decimal(18,0)") * 100 > limit * total.cast("decimal(18,0)"),
                F.concat(F.lit(f"too many NULLs in {name}: "), nulls.cast("string")),
            )
        )
    reasons.append(
        F.when(
            F.col("invalid_records") > 0,
            F.concat(F.lit("business rules broken: "), F.col("invalid_records").cast("string")),
        )
    )
    reason = F.coalesce(*reasons)
    return checked.select(
        "etl_batch_id",
        "total_records",
        "invalid_records",
        F.when(reason.isNull(), LOAD).otherwise(STOP).alias("decision"),
        reason.alias("failure_reason"),
    )


def batch_decisions(
    expected: DataFrame,
    checked: DataFrame,
    markers: DataFrame,
    min_records: int = MIN_RECORD_COUNT,
    max_null_percentage: float = MAX_NULL_PERCENTAGE,
    max_failing_percentage: float = MAX_FAILING_PERCENTAGE,
    critical: Sequence[str] = tuple(CRITICAL_COLUMNS),
) -> DataFrame:
    """A decision about every expected batch, whether anything came for it or not.

    ``expected`` is the registry of batches (``etl_batch_id``), ``checked`` holds
    their live rows with the reason a row fails for, before any is set aside,
    ``markers`` their deletes. Batches that are not in the registry are judged
    as well. All three are counted in one aggregation over their union, so no
    row is joined.

    NULLs in critical columns and a large share of failing rows stop a batch,
    deletes included: something is wrong with all of it. Failing rows below
    that share are set aside one by one. Too few live rows hold only these
    back, not the deletes.
    """
    live = checked.select(
        "etl_batch_id",
        F.lit(1).alias("_live"),
        F.lit(0).alias("_marker"),
        F.col("validation_failure_reason").isNotNull().alias("_fails"),
        *[F.col(name).isNull().alias(f"_null_{name}") for name in critical],
    )
    no = {"_fails": F.lit(False), **{f"_null_{name}": F.lit(False) for name in critical}}
    gone = markers.select("etl_batch_id", F.lit(0).alias("_live"), F.lit(1).alias("_marker")).withColumns(no)
    listed = expected.select("etl_batch_id", F.lit(0).alias("_live"), F.lit(0).alias("_marker")).withColumns(no)
    counted = (
        live.unionByName(gone)
        .unionByName(listed)
        .groupBy("etl_batch_id")
        .agg(
            F.sum("_live").alias("total_records"),
            F.sum("_marker").alias("delete_markers"),
            F.count_if("_fails").alias("failing_records"),
            *[F.count_if(f"_null_{name}").alias(f"null_{name}") for name in critical],
        )
    )
    total = F.col("total_records")

    def above(part: str, limit: float) -> Column:
        return F.col(part).cast("decimal(18,0)") * 100 > F.lit(Decimal(str(limit))) * total.cast("decimal(18,0)")

    reasons = [
        F.when(above(f"null_{name}", max_null_percentage), F.concat(F.lit(f"too many NULLs in {name}: "), F.col(f"null_{name}").cast("string")))
        for name in critical
    ]
    reasons.append(
        F.when(above("failing_records", max_failing_percentage), F.concat(F.lit("too many failing rows: "), F.col("failing_records").cast("string")))
    )
    broken = F.coalesce(*reasons)
    few = total < min_records
    some_deletes = F.col("delete_markers") > 0
    decision = (
        F.when((total == 0) & ~some_deletes, NO_DATA)
        .when(broken.isNotNull(), STOP)
        .when(few & some_deletes, DELETES_ONLY)
        .when(few, STOP)
        .otherwise(LOAD)
    )
    reason = F.coalesce(broken, F.when(few, F.concat(F.lit("too few records: "), total.cast("string"))))
    return counted.select(
        "etl_batch_id", "total_records", "delete_markers", "failing_records", decision.alias("decision"), reason.alias("failure_reason")
    )


def route_batches(df: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows into those of admitted batches and those of stopped ones.

    The decision frame has one row per batch, so the join never grows a row
    set; Spark picks broadcast or shuffle by its measured size.
    """
    marked = df.join(decisions.select("etl_batch_id", "decision", "failure_reason"), on="etl_batch_id", how="left")
    admitted = marked.filter(F.col("decision") == LOAD).drop("decision", "failure_reason")
    stopped = marked.filter(~F.col("decision").eqNullSafe(F.lit(LOAD))).drop("decision")
    return admitted, stopped


def extraction_counts(extract: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows extracted per configured region (zero if none) beside the run's total.

    The extract is read once: a rollup counts regions and the whole together,
    and the total is handed to every region's row.
    """
    counts = extract.rollup("region").agg(F.count(F.lit(1)).alias("record_count"), F.grouping("region").alias("_whole"))
    listed = regions.select(F.col("name").alias("region"), F.lit(True).alias("_listed"))
    both = listed.withColumn("_whole", F.lit(0).cast("tinyint")).join(counts, on=["region", "_whole"], how="full_outer")
    # One row per region: few enough for a window over all of them.
    total = F.max(F.when(F.col("_whole") == 1, F.col("record_count"))).over(Window.partitionBy())
    zero = F.lit(0).cast("bigint")
    with_total = both.withColumn("total_extracted", F.coalesce(total, zero)).filter("_listed")
    return with_total.select("region", F.coalesce("record_count", zero).alias("record_count"), "total_extracted")


def transform_metrics(extract: DataFrame, transformed: DataFrame, batch_id: str) -> DataFrame:
    """Extracted, duplicate, transformed and marker counts of one batch."""
    live = F.col("is_deleted") == F.lit(False)
    before = extract.agg(
        F.count(F.lit(1)).alias("total_extracted"),
        (F.count_if(live) - F.count_distinct(F.when(live, F.col("sale_id")))).alias("duplicates_removed"),
        F.count_if("is_deleted").alias("delete_markers"),
    )
    loaded = transformed.agg(F.count_if(live).alias("transformed_records")).scalar()
    return before.select(
        F.lit(batch_id).alias("etl_batch_id"),
        "*",
        loaded.alias("transformed_records"),
        F.when(F.col("total_extracted") == 0, "no_data").otherwise("success").alias("status"),
    )


def batch_counts(fact: DataFrame) -> DataFrame:
    """Rows per batch id."""
    return fact.groupBy("etl_batch_id").agg(F.count(F.lit(1)).alias("record_count"))


def reconcile_load(changes: DataFrame, actions: DataFrame) -> DataFrame:
    """Live rows a batch meant to load against rows its merge inserted or updated.

    Both sides are counted in one aggregation over their union.
    """
    expected = changes.filter(~F.col("is_deleted")).select("etl_batch_id", F.lit(True).alias("_expected"))
    loaded = actions.filter(F.col(ACTION).isin("insert", "update")).select("etl_batch_id", F.lit(False).alias("_expected"))
    both = (
        expected.unionByName(loaded)
        .groupBy("etl_batch_id")
        .agg(F.count_if("_expected").alias("expected_count"), F.count_if(~F.col("_expected")).alias("actual_count"))
    )
    matches = F.col("expected_count") == F.col("actual_count")
    return both.withColumn("status", F.when(matches, "success").otherwise("mismatch"))


def duplicate_count(fact: DataFrame, key: str = "sale_id") -> DataFrame:
    """Number of keys that occur more than once within a batch, per batch."""
    repeated = fact.groupBy("etl_batch_id", key).agg(F.count(F.lit(1)).alias("n"))
    return repeated.groupBy("etl_batch_id").agg(F.count_if(F.col("n") > 1).alias("duplicate_count"))
