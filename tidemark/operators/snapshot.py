"""Version history of a table (validity intervals, open end = NULL)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import version_key

VERSION_COLUMNS = ["dbt_scd_id", "dbt_valid_from", "dbt_valid_to", "dbt_updated_at"]  # fixed values


def first_snapshot(source: DataFrame, key: str = "sale_id", updated_at: str = "updated_at") -> DataFrame:
    """Every source row as its first, open version."""
    stamp = F.col(updated_at)
    return source.withColumns(
        {
            "dbt_scd_id": version_key(key, updated_at),
            "dbt_valid_from": stamp,
            "dbt_valid_to": F.lit(None).cast("timestamp_ntz"),
            "dbt_updated_at": stamp,
        }
    )


def _changed_columns(columns: Sequence[str]) -> Column:
    differs: Column = F.lit(False)
    for name in columns:
        differs = differs | ~F.col(f"open.{name}").eqNullSafe(F.col(f"src.{name}"))
    return differs


def take_snapshot(
    history: DataFrame,
    source: DataFrame,
    as_of: dt.datetime,
    key: str = "sale_id",
    updated_at: str = "updated_at",
    invalidate_hard_deletes: bool = True,
    check_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Bring a history up to date with its source.

    New keys open a version; a changed key closes its open version and opens
    another; a vanished key closes at ``as_of`` when ``invalidate_hard_deletes``.
    Changed means a newer ``updated_at``, or, with ``check_columns``, any
    difference in those columns; the latter opens the new version at ``as_of``.

    Closed versions take no part in the join: they pass through unchanged.
    """
    columns = source.columns
    closed = history.filter(F.col("dbt_valid_to").isNotNull())
    current = history.filter(F.col("dbt_valid_to").isNull())
    now = F.lit(as_of).cast("timestamp_ntz")

    pairs = current.withColumn("_open", F.lit(True)).alias("open").join(
        source.withColumn("_src", F.lit(True)).alias("src"),
        on=F.col(f"open.{key}") == F.col(f"src.{key}"),
        how="full_outer",
    )
    has_open, has_source = F.col("open._open").isNotNull(), F.col("src._src").isNotNull()
    if check_columns is None:
        changed = F.coalesce(F.col(f"src.{updated_at}") > F.col(f"open.{updated_at}"), F.lit(False))
        opens_at = F.col(f"src.{updated_at}")
    else:
        changed = _changed_columns(check_columns)
        opens_at = F.when(has_open, now).otherwise(F.col(f"src.{updated_at}"))
    changed = has_open & has_source & changed
    vanished = has_open & ~has_source & F.lit(invalidate_hard_deletes)

    closes_at = F.when(changed, opens_at).when(vanished, now)
    old_version = F.struct(
        *[F.col(f"open.{name}").alias(name) for name in columns],
        F.col("open.dbt_scd_id").alias("dbt_scd_id"),
        F.col("open.dbt_valid_from").alias("dbt_valid_from"),
        closes_at.alias("dbt_valid_to"),
        F.col("open.dbt_updated_at").alias("dbt_updated_at"),
    )
    new_version = F.struct(
        *[F.col(f"src.{name}").alias(name) for name in columns],
        version_key(F.col(f"src.{key}"), opens_at).alias("dbt_scd_id"),
        opens_at.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
        opens_at.alias("dbt_updated_at"),
    )
    versions = F.filter(
        F.array(F.when(has_open, old_version), F.when(changed | ~has_open, new_version)),
        lambda version: version.isNotNull(),
    )
    refreshed = pairs.select(F.inline(versions))
    return closed.select(*refreshed.columns).unionByName(refreshed)


def current_versions(history: DataFrame) -> DataFrame:
    """Open versions only."""
    return history.filter(F.col("dbt_valid_to").isNull())


def versions_at(history: DataFrame, moment: dt.datetime) -> DataFrame:
    """Versions that were valid at ``moment``."""
    at = F.lit(moment).cast("timestamp_ntz")
    still_valid = F.col("dbt_valid_to").isNull() | (F.col("dbt_valid_to") > at)
    return history.filter((F.col("dbt_valid_from") <= at) & still_valid)
