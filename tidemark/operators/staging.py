"""Split, clean and type staged rows; the batch transform."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import region_label
from tidemark.operators.dedup import latest_live_row
from tidemark.operators.enrich import derive_amounts, derive_date_parts
from tidemark.schemas import DELETE_MARKER_COLUMNS, STAGING_MODEL_COLUMNS, conform


def with_batch(df: DataFrame) -> DataFrame:
    """Drop rows that carry no batch id."""
    return df.filter(F.col("etl_batch_id").isNotNull())


def split_live(df: DataFrame) -> DataFrame:
    """Rows that are not deleted; a NULL flag is in neither side of the split."""
    return df.filter(~F.col("is_deleted"))


def split_deleted(df: DataFrame) -> DataFrame:
    """Rows flagged as deleted."""
    return df.filter(F.col("is_deleted"))


def delete_markers(df: DataFrame) -> DataFrame:
    """Distinct delete markers, reduced to what a delete needs."""
    return split_deleted(with_batch(df)).select(*DELETE_MARKER_COLUMNS).distinct()


def default_amounts(df: DataFrame) -> DataFrame:
    """Missing discount or tax means none was given."""
    zero = F.lit(0).cast("decimal(10,2)")
    return df.withColumns(
        {name: F.coalesce(F.col(name), zero) for name in ("discount_amount", "tax_amount")}
    )


def stage_transactions(df: DataFrame) -> DataFrame:
    """The staging model: latest live row per sale, typed, defaults filled."""
    latest = latest_live_row(split_live(with_batch(df)))
    return default_amounts(conform(latest, STAGING_MODEL_COLUMNS))


def normalise_region(df: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """Replace region codes by display names; unknown codes become NULL."""
    return df.withColumn("region", region_label("region", labels))


def stamp_load(df: DataFrame, loaded_at: dt.datetime, batch_id: str) -> DataFrame:
    """Record when and by which batch the rows were loaded."""
    return df.withColumns(
        {
            "etl_loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
            "etl_batch_id": F.lit(batch_id),
        }
    )


def positive_rows(df: DataFrame) -> DataFrame:
    """Keep rows with positive quantity, price and total; NULL fails."""
    return df.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0) & (F.col("total_amount") > 0))


def union_live_and_markers(live: DataFrame, markers: DataFrame) -> DataFrame:
    """Live rows and delete markers in one frame, matched by column name."""
    return live.unionByName(markers, allowMissingColumns=True)


def transform_live(
    extract: DataFrame, loaded_at: dt.datetime, batch_id: str, labels: dict[str, str] | None = None
) -> DataFrame:
    """Deduplicate, fill, derive and filter the live rows of one batch."""
    live = default_amounts(latest_live_row(split_live(extract)))
    live = derive_date_parts(derive_amounts(live))
    return positive_rows(stamp_load(normalise_region(live, labels), loaded_at, batch_id))


def transform_batch(
    extract: DataFrame, loaded_at: dt.datetime, batch_id: str, labels: dict[str, str] | None = None
) -> DataFrame:
    """The batch transform: transformed live rows plus untouched delete markers."""
    live = transform_live(extract, loaded_at, batch_id, labels)
    markers = stamp_load(normalise_region(split_deleted(extract), labels), loaded_at, batch_id)
    return union_live_and_markers(live, markers)
