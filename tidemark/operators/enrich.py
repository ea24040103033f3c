"""Derived amounts, date parts and row validation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import amount_is_plausible, failure_reason
from tidemark.schemas import FACT_COLUMNS, conform


def derive_amounts(df: DataFrame) -> DataFrame:
    """``net_amount`` after discount and ``gross_profit`` after tax."""
    net = F.col("total_amount") - F.col("discount_amount")
    return df.withColumns(
        {
            "net_amount": net.cast("decimal(10,2)"),
            "gross_profit": (net - F.col("tax_amount")).cast("decimal(10,2)"),
        }
    )


def derive_date_parts(df: DataFrame) -> DataFrame:
    """Year, month and day of the sale."""
    return df.withColumns(
        {
            "sale_year": F.year("sale_date"),
            "sale_month": F.month("sale_date"),
            "sale_day": F.dayofmonth("sale_date"),
        }
    )


def enrich(staged: DataFrame) -> DataFrame:
    """Everything computed from one row: amounts, date parts, plausibility flag."""
    derived = derive_date_parts(derive_amounts(staged))
    return derived.withColumn("is_amount_valid", amount_is_plausible())


def with_reason(enriched: DataFrame) -> DataFrame:
    """Attach the first broken rule, NULL for a row that passes."""
    return enriched.withColumn("validation_failure_reason", failure_reason())


def passed(checked: DataFrame) -> DataFrame:
    """Rows without a failure reason."""
    return checked.filter(F.col("validation_failure_reason").isNull())


def quarantined(checked: DataFrame) -> DataFrame:
    """Rows with a failure reason, reason included."""
    return checked.filter(F.col("validation_failure_reason").isNotNull())


def as_fact(validated: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Fact rows, both audit stamps set to the run time."""
    now = F.lit(as_of).cast("timestamp_ntz")
    stamped = validated.withColumns({"_row_inserted_at": now, "_row_updated_at": now})
    return conform(stamped, FACT_COLUMNS)
