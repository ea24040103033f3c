"""Dimensions, daily and monthly aggregates, metrics.

Counts of distinct customers and stores stay exact. Spark expands such rows
once per distinct column and pre-aggregates before each shuffle, so a region
with a large share of all rows is spread over (region, customer) first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import exact_avg, percent_change, surrogate_key
from tidemark.schemas import PAYMENT_METHODS


def _money(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def _now(as_of: dt.datetime) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def dim_regions(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per region with its activity and revenue."""
    stats = fact.groupBy("region").agg(
        F.count_distinct("store_id").alias("store_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
        F.count(F.lit(1)).alias("total_transactions"),
        _money(F.sum("total_amount")).alias("total_revenue"),
        exact_avg("total_amount").alias("avg_order_value"),
    )
    return stats.select(
        surrogate_key("region").alias("region_key"),
        F.col("region").alias("region_name"),
        *stats.columns[1:],
        _now(as_of).alias("_loaded_at"),
    )


def dim_stores(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per store and region; a store that moved has one per region."""
    stats = fact.groupBy("store_id", "region").agg(
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        _money(F.sum("total_amount")).alias("total_revenue"),
        exact_avg("total_amount").alias("avg_order_value"),
    )
    return stats.select(surrogate_key("store_id").alias("store_key"), "*", _now(as_of).alias("_loaded_at"))


def payment_counts(methods: Sequence[str] = tuple(PAYMENT_METHODS)) -> list[Column]:
    """One order count per payment method."""
    return [F.count_if(F.col("payment_method") == method).alias(f"{method}_orders") for method in methods]


def payment_mix(fact: DataFrame) -> DataFrame:
    """Order counts per region and payment method, one column per method."""
    return fact.groupBy("region").agg(F.count(F.lit(1)).alias("order_count"), *payment_counts())


def latest_batch() -> Column:
    """The newest batch id of a group.

    Batch ids are dates written as digits, so they compare as numbers. A
    maximum over text would turn the whole aggregation from hashing to sorting,
    because text does not fit a fixed-width aggregation buffer.
    """
    return F.max(F.col("etl_batch_id").cast("bigint")).cast("string")


def daily_sales(fact: DataFrame, as_of: dt.datetime) -> DataFrame:
    """KPIs per day and region."""
    return (
        fact.groupBy(F.to_date("sale_date").alias("sale_date"), "region")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("quantity").alias("total_units_sold"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("store_id").alias("active_stores"),
            _money(F.sum("total_amount")).alias("gross_revenue"),
            _money(F.sum("discount_amount")).alias("total_discounts"),
            _money(F.sum("tax_amount")).alias("total_tax"),
            _money(F.sum("net_amount")).alias("net_revenue"),
            _money(F.sum("gross_profit")).alias("gross_profit"),
            exact_avg("total_amount").alias("avg_order_value"),
            exact_avg("quantity").alias("avg_units_per_order"),
            *payment_counts(),
            latest_batch().alias("latest_batch_id"),
        )
        .withColumn("_aggregated_at", _now(as_of))
    )


def monthly_revenue(fact: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    """Revenue per month and region with the change over the month before."""
    since = F.add_months(F.lit(as_of).cast("date"), -months)
    monthly = (
        fact.filter(F.col("sale_date") >= since.cast("timestamp_ntz"))
        .groupBy(F.trunc("sale_date", "month").alias("month"), "region")
        .agg(
            _money(F.sum("net_amount")).alias("monthly_revenue"),
            _money(F.sum("gross_profit")).alias("monthly_profit"),
            F.count(F.lit(1)).alias("order_count"),
            F.sum("quantity").alias("units_sold"),
            F.count_distinct("customer_id").alias("unique_customers"),
            exact_avg("net_amount").alias("avg_order_value"),
        )
    )
    previous = F.lag("monthly_revenue").over(Window.partitionBy("region").orderBy("month"))
    return (
        monthly.withColumn("prev_month_revenue", previous)
        .withColumn("mom_growth_pct", percent_change(F.col("monthly_revenue"), F.col("prev_month_revenue")))
        .orderBy(F.desc("month"), F.asc("region"))
    )


def batch_monitor(fact: DataFrame) -> DataFrame:
    """What each batch loaded, newest batch first."""
    return (
        fact.groupBy("etl_batch_id")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min("sale_date").alias("min_sale_date"),
            F.max("sale_date").alias("max_sale_date"),
            _money(F.sum("total_amount")).alias("total_sales"),
            F.count_distinct("region").alias("region_count"),
            F.max("etl_loaded_at").alias("last_loaded_at"),
        )
        .orderBy(F.desc("etl_batch_id"))
    )


def latest_rows(df: DataFrame, *order: Column, limit: int = 20) -> DataFrame:
    """The newest ``limit`` rows of a log."""
    return df.orderBy(*order).limit(limit)


def sales_with_payment(fact: DataFrame, methods: DataFrame) -> DataFrame:
    """Fact rows with the payment method's display name; unknown methods stay."""
    details = methods.select(
        "payment_method", F.col("display_name").alias("payment_display_name"), "is_digital"
    )
    return fact.join(details, on="payment_method", how="left")


def revenue_by_dimension(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per region of the store dimension.

    The fact is summed per store before the join, so a store with many sales
    joins as a single row. A store listed under several regions counts in each.
    """
    per_store = fact.groupBy("store_id").agg(
        F.sum("total_amount").alias("store_revenue"), F.count(F.lit(1)).alias("store_sales")
    )
    return (
        per_store.join(stores.select("store_id", F.col("region").alias("store_region")), on="store_id")
        .groupBy("store_region")
        .agg(_money(F.sum("store_revenue")).alias("revenue"), F.sum("store_sales").alias("sale_count"))
    )


def gap_filled_daily(daily: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Every day from ``start`` to ``end`` for every region seen, zeros where nothing was sold.

    Without bounds the first and the last day with a sale are taken. Days are
    generated per region row, so no join without keys is needed.
    """
    first, last = (
        F.lit(day) if day else daily.agg(pick("sale_date").alias("day")).scalar() for day, pick in ((start, F.min), (end, F.max))
    )
    spine = daily.select("region").distinct().select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("sale_date"), "region"
    )
    measures = daily.select("sale_date", "region", "order_count", "net_revenue")
    zero = F.lit(0)
    return spine.join(measures, on=["sale_date", "region"], how="left").select(
        "sale_date",
        "region",
        F.coalesce("order_count", zero.cast("bigint")).alias("order_count"),
        F.coalesce("net_revenue", zero.cast("decimal(18,2)")).alias("net_revenue"),
    )


def region_pivot(fact: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Orders per month with one column per region."""
    months = F.trunc("sale_date", "month").alias("month")
    counted = fact.groupBy(months).agg(
        *[
            F.count_if(F.col("region") == region).alias(region.lower().replace(" ", "_").replace("-", "_") + "_orders")
            for region in regions
        ]
    )
    return counted


def kpi_unpivot(daily: DataFrame, measures: Sequence[str], ids: Sequence[str] = ("sale_date", "region")) -> DataFrame:
    """Daily KPIs as (ids, measure, value) rows."""
    widened = daily.select(*ids, *[F.col(name).cast("decimal(18,2)").alias(name) for name in measures])
    return widened.unpivot(list(ids), list(measures), "measure", "value")


def cumulative_revenue(daily: DataFrame, days: int = 28) -> DataFrame:
    """Net revenue of the last ``days`` calendar days, per day and region.

    Runs over one row per day and region, so a window partition is bounded by
    the number of days whatever the number of sales.
    """
    day_number = F.date_diff("sale_date", F.lit(dt.date(1970, 1, 1)))
    frame = Window.partitionBy("region").orderBy("day_number").rangeBetween(-(days - 1), 0)
    return daily.withColumn("day_number", day_number).select(
        "sale_date", "region", _money(F.sum("net_revenue").over(frame)).alias(f"net_revenue_{days}d")
    )


def revenue_metrics(fact: DataFrame) -> DataFrame:
    """Simple metrics per region and the ratios derived from them."""
    simple = fact.groupBy("region").agg(
        _money(F.sum("net_amount")).alias("revenue"),
        _money(F.sum("gross_profit")).alias("profit"),
        F.count(F.lit(1)).alias("order_count"),
    )
    orders = F.nullif(F.col("order_count"), F.lit(0))
    base = F.nullif(F.col("revenue"), F.lit(0).cast("decimal(18,2)"))
    return simple.withColumns(
        {
            "revenue_per_order": (F.col("revenue") / orders).cast("decimal(18,2)"),
            "profit_margin_pct": (F.col("profit") / base * 100).cast("decimal(18,2)"),
        }
    )


def conversion_rate(events: DataFrame, base: str = "view", goal: str = "purchase") -> DataFrame:
    """Per day: users with the base event, users with the goal, and their share.

    Users are flagged per day first, so each counts once and a very active
    user is reduced before the shuffle.
    """
    per_user = events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(
        F.bool_or(F.col("event_type") == base).alias("has_base"),
        F.bool_or(F.col("event_type") == goal).alias("has_goal"),
    )
    counts = per_user.groupBy("day").agg(
        F.count_if("has_base").alias("base_users"),
        F.count_if(F.col("has_base") & F.col("has_goal")).alias("converted_users"),
    )
    share = F.col("converted_users").cast("decimal(18,2)") / F.nullif(F.col("base_users"), F.lit(0)) * 100
    return counts.withColumn("conversion_pct", share.cast("decimal(18,2)"))


def insert_update_tally(fact: DataFrame) -> DataFrame:
    """Per batch: rows never changed since creation, and rows changed."""
    unchanged = F.col("created_at") == F.col("updated_at")
    return fact.groupBy("etl_batch_id").agg(
        F.count_if(unchanged).alias("inserts"),
        F.count_if(~unchanged).alias("updates"),
    )
