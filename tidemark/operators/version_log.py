"""A version history as a log: versions that were opened, and ends of versions.

Nothing stored is written again. A run adds the versions it opens and, for the
versions it closes, their end; both are as many as the keys it changed. The
history with its validity intervals is the join of the two.

A version is told apart by its id and the run that opened it, so a key that is
deleted and comes back unchanged has two.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType

from tidemark.functions import version_key
from tidemark.operators.merge import ACTION

CLOSED_DDL = "dbt_scd_id string, version_run string, dbt_valid_to timestamp_ntz, run string"
RUN = "run"
_ID, _UPDATED, _BY = "_open_id", "_open_updated", "_open_run"


def opened_schema(source: StructType) -> StructType:
    """Opened versions of rows of ``source``."""
    schema = StructType(list(source.fields)).add("dbt_scd_id", StringType())
    return schema.add("dbt_valid_from", TimestampNTZType()).add("dbt_updated_at", TimestampNTZType()).add(RUN, StringType())


def _version(rows: DataFrame, columns: Sequence[str], key: str, updated_at: str) -> DataFrame:
    stamp = F.col(updated_at)
    return rows.select(
        *columns, version_key(key, updated_at).alias("dbt_scd_id"), stamp.alias("dbt_valid_from"), stamp.alias("dbt_updated_at")
    )


def first_versions(source: DataFrame, key: str = "sale_id", updated_at: str = "updated_at") -> DataFrame:
    """Every row as the version that opens its history."""
    return _version(source, source.columns, key, updated_at)


def with_open_versions(changed: DataFrame, opened: DataFrame, closed: DataFrame, keys: Sequence[str] = ("sale_id",)) -> DataFrame:
    """Changed rows (with their merge action) beside the open version of their key, if it has one.

    Of the log only keys and ids are read, and only those of changed keys go
    into the search for ends.
    """
    names = [F.col("dbt_scd_id").alias(_ID), F.col("dbt_updated_at").alias(_UPDATED), F.col(RUN).alias(_BY)]
    of_changed = opened.select(*keys, *names).join(changed.select(*keys), list(keys), "left_semi")
    ends = closed.select(F.col("dbt_scd_id").alias(_ID), F.col("version_run").alias(_BY))
    return changed.join(of_changed.join(ends, [_ID, _BY], "left_anti"), list(keys), "left")


def _newer(updated_at: str) -> Column:
    return F.coalesce(F.col(updated_at) > F.col(_UPDATED), F.lit(False))


def opened(pairs: DataFrame, columns: Sequence[str], key: str = "sale_id", updated_at: str = "updated_at") -> DataFrame:
    """Versions that changed rows open: of keys without an open one, and of newer rows."""
    written = F.col(ACTION).isin("insert", "update")
    return _version(pairs.filter(written & (F.col(_ID).isNull() | _newer(updated_at))), columns, key, updated_at)


def closed(pairs: DataFrame, as_of: dt.datetime, updated_at: str = "updated_at") -> DataFrame:
    """Ends of versions: of deleted keys at ``as_of``, of those that a newer row replaces when that was updated."""
    gone = F.col(ACTION) == "delete"
    end = F.when(gone, F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col(updated_at))
    ended = pairs.filter(F.col(_ID).isNotNull() & (gone | _newer(updated_at)))
    return ended.select(F.col(_ID).alias("dbt_scd_id"), F.col(_BY).alias("version_run"), end.alias("dbt_valid_to"))


def versions_with_ends(opened: DataFrame, closed: DataFrame) -> DataFrame:
    """All versions with their validity; the end of an open one is NULL."""
    ends = closed.select(F.col("dbt_scd_id").alias(_ID), F.col("version_run").alias(_BY), "dbt_valid_to")
    both = opened.join(ends, (F.col("dbt_scd_id") == F.col(_ID)) & (F.col(RUN) == F.col(_BY)), "left")
    columns = [name for name in opened.columns if name not in ("dbt_updated_at", RUN)]
    return both.select(*columns, "dbt_valid_to", "dbt_updated_at")
