"""Frames the registered queries start from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import enrich, staging
from tidemark.operators.dedup import latest_change_per_key
from tidemark.schemas import COMPLETED, STAGING_MODEL_COLUMNS
from tidemark.sources.change_events import change_log
from tidemark.sources.tables import sales_rows
from tidemark.streaming.envelope import parse_envelopes

AS_OF = dt.datetime(2001, 8, 1)
CUT = dt.datetime(2000, 7, 1)
EVENTS_AS_OF = dt.datetime(2024, 3, 1)


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """All sales rows, whatever their status."""
    return sales_rows(spark, sf)


def completed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of completed sales."""
    return sales(spark, sf).filter(F.col("status") == COMPLETED)


def taken(spark: SparkSession, sf: str, completed_only: bool) -> DataFrame:
    """The sales rows that models are built from: all, or those of completed sales."""
    return completed(spark, sf) if completed_only else sales(spark, sf)


def checked(rows: DataFrame) -> DataFrame:
    """Staged, enriched rows with their failure reason."""
    return enrich.with_reason(enrich.enrich(staging.stage_transactions(rows)))


def validated(spark: SparkSession, sf: str, completed_only: bool = False) -> DataFrame:
    return enrich.passed(checked(taken(spark, sf, completed_only)))


def fact(spark: SparkSession, sf: str, completed_only: bool = False) -> DataFrame:
    return enrich.as_fact(validated(spark, sf, completed_only), AS_OF)


def fact_of(rows: DataFrame, stamp: dt.datetime) -> DataFrame:
    return enrich.as_fact(enrich.passed(checked(rows)), stamp)


def before_cut(spark: SparkSession, sf: str, completed_only: bool = False) -> DataFrame:
    return taken(spark, sf, completed_only).filter(F.col("updated_at") < F.lit(CUT).cast("timestamp_ntz"))


def after_cut(spark: SparkSession, sf: str, completed_only: bool = False) -> DataFrame:
    return taken(spark, sf, completed_only).filter(F.col("updated_at") >= F.lit(CUT).cast("timestamp_ntz"))


def old_fact(spark: SparkSession, sf: str, completed_only: bool = False) -> DataFrame:
    """The fact as built from all versions before the cut."""
    return fact_of(before_cut(spark, sf, completed_only), CUT)


def changes(spark: SparkSession, sf: str, completed_only: bool = False) -> DataFrame:
    """One change per key from all versions since the cut: valid live rows and deletes."""
    rows = after_cut(spark, sf, completed_only)
    live = enrich.passed(checked(rows)).drop("is_amount_valid", "validation_failure_reason")
    deleted = staging.split_deleted(rows).select(*STAGING_MODEL_COLUMNS)
    return latest_change_per_key(staging.union_live_and_markers(live, deleted))


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    return change_log(spark, sf)


def staged_events(spark: SparkSession, sf: str) -> DataFrame:
    return parse_envelopes(raw_events(spark, sf), EVENTS_AS_OF)

