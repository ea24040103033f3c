"""High-water marks and incremental models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import daily_sales
from tidemark.operators.enrich import as_fact
from tidemark.operators.merge import delete_by_markers, upsert

EPOCH_FLOOR = dt.datetime(1900, 1, 1)  # fixed value: mark of an empty table


def high_water_mark(target: DataFrame, column: str, lookback_days: int = 0) -> Column:
    """The largest ``column`` in the table as a scalar subquery.

    ``lookback_days`` moves the mark back, so late rows are taken again.
    """
    floor = F.lit(EPOCH_FLOOR).cast(target.schema[column].dataType)
    mark = target.agg(F.coalesce(F.max(column), floor).alias("mark")).scalar()
    if lookback_days:
        mark = mark - F.make_dt_interval(F.lit(lookback_days))
    return mark


def newer_than(source: DataFrame, target: DataFrame, column: str = "etl_loaded_at", lookback_days: int = 0) -> DataFrame:
    """Source rows past the table's high-water mark."""
    return source.filter(F.col(column) > high_water_mark(target, column, lookback_days))


def incremental_fact(
    target: DataFrame,
    validated: DataFrame,
    as_of: dt.datetime,
    markers: DataFrame | None = None,
    lookback_days: int = 0,
) -> DataFrame:
    """Upsert newly loaded validated rows, then drop rows marked as deleted."""
    delta = as_fact(newer_than(validated, target, lookback_days=lookback_days), as_of)
    table = upsert(target, delta, as_of)
    return table if markers is None else delete_by_markers(table, markers)


def touched_groups(old_fact: DataFrame, new_fact: DataFrame, changed: DataFrame, key: str = "sale_id") -> DataFrame:
    """The (day, region) groups a change set affects.

    A changed sale counts where it was and where it is now, so both versions
    of the fact are looked up.
    """
    keys = changed.filter(F.col(key).isNotNull()).select(key).distinct()
    sides = [fact.select(key, F.to_date("sale_date").alias("sale_date"), "region") for fact in (old_fact, new_fact)]
    return sides[0].unionByName(sides[1]).join(keys, on=key, how="left_semi").select("sale_date", "region").distinct()


def incremental_daily_high_water(daily: DataFrame, fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Re-aggregate only days from the newest aggregated day on."""
    mark = high_water_mark(daily, "sale_date")
    recent = daily_sales(fact.filter(F.col("sale_date") >= mark.cast("timestamp_ntz")), as_of)
    return upsert(daily, recent, as_of, keys=("sale_date", "region"), insert_only=("sale_date", "region"))


def incremental_daily_touched(
    daily: DataFrame, old_fact: DataFrame, new_fact: DataFrame, changed: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """Re-aggregate exactly the groups a change set affects.

    Groups that lost their last sale disappear.
    """
    groups = touched_groups(old_fact, new_fact, changed)
    keys = ["sale_date", "region"]
    in_touched = new_fact.withColumn("_day", F.to_date("sale_date")).join(
        groups.select(F.col("sale_date").alias("_day"), "region"), on=["_day", "region"], how="left_semi"
    )
    kept = daily.join(groups, on=keys, how="left_anti")
    return kept.unionByName(daily_sales(in_touched.drop("_day"), as_of))


def month_slices(start: dt.date, end: dt.date, months: int) -> list[tuple[dt.date, dt.date]]:
    """Half-open slices of whole months covering ``[start, end)`` for slice-wise rebuilds.

    Edges fall on month starts, so slices never share a month partition.
    """
    if start.day != 1 or end.day != 1:
        raise ValueError("slices start and end on the first day of a month")
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    edges = [*range(first, last, months), last]
    days = [dt.date(edge // 12, edge % 12 + 1, 1) for edge in edges]
    return list(zip(days, days[1:]))
