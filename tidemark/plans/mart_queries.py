"""Registered queries: dimensions, aggregates, reports, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregates
from tidemark.operators.merge import cdc_merge
from tidemark.plans import inputs
from tidemark.plans.oracle import AS_OF, average, cents, money, quotient, sql
from tidemark.plans.registry import query
from tidemark.sources import files
from tidemark.sources.tables import REGIONS, events


@query(
    sql(
        "fact",
        f"""SELECT md5(coalesce(region, '_dbt_utils_surrogate_key_null_')) AS region_key, region AS region_name,
  count(DISTINCT store_id) AS store_count, count(DISTINCT customer_id) AS customer_count,
  min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date, count(*) AS total_transactions,
  {money('sum(total_amount)')} AS total_revenue, {average('total_amount')} AS avg_order_value, {AS_OF} AS _loaded_at
FROM fact GROUP BY region""",
    )
)
def dim_regions(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.dim_regions(inputs.fact(spark, sf), inputs.AS_OF)


@query(sql("stores", "SELECT * FROM stores"))
def dim_stores(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.dim_stores(inputs.fact(spark, sf), inputs.AS_OF)


@query(sql("daily", "SELECT * FROM daily"))
def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.daily_sales(inputs.fact(spark, sf), inputs.AS_OF)


@query(
    sql(
        "fact",
        """SELECT region, count(*) AS order_count,
  CAST(sum(CASE WHEN payment_method = 'credit' THEN 1 ELSE 0 END) AS BIGINT) AS credit_orders,
  CAST(sum(CASE WHEN payment_method = 'cash' THEN 1 ELSE 0 END) AS BIGINT) AS cash_orders,
  CAST(sum(CASE WHEN payment_method = 'debit' THEN 1 ELSE 0 END) AS BIGINT) AS debit_orders
FROM fact GROUP BY region""",
    )
)
def payment_mix(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.payment_mix(inputs.fact(spark, sf))


_GROWTH = quotient(
    f"({cents('monthly_revenue')} - {cents('prev_month_revenue')}) * 10000", f"{cents('prev_month_revenue')}", "DECIMAL(18,2)"
)


@query(
    sql(
        "fact",
        f"""SELECT *, CASE WHEN prev_month_revenue <> 0 THEN {_GROWTH} END AS mom_growth_pct FROM (
  SELECT *, lag(monthly_revenue) OVER (PARTITION BY region ORDER BY month) AS prev_month_revenue FROM (
    SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, region, {money('sum(net_amount)')} AS monthly_revenue,
      {money('sum(gross_profit)')} AS monthly_profit, count(*) AS order_count,
      CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT customer_id) AS unique_customers,
      {average('net_amount')} AS avg_order_value
    FROM fact WHERE sale_date >= TIMESTAMP '2000-08-01' GROUP BY 1, 2) m) p""",
    )
)
def monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.monthly_revenue(inputs.fact(spark, sf), inputs.AS_OF.date())


_MONITOR = f"""SELECT etl_batch_id, count(*) AS record_count, min(sale_date) AS min_sale_date,
  max(sale_date) AS max_sale_date, {money('sum(total_amount)')} AS total_sales,
  count(DISTINCT region) AS region_count, max(etl_loaded_at) AS last_loaded_at FROM fact GROUP BY etl_batch_id"""


@query(sql("fact", _MONITOR))
def batch_monitor(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.batch_monitor(inputs.fact(spark, sf))


@query(sql("fact", f"SELECT * FROM ({_MONITOR}) m ORDER BY etl_batch_id DESC LIMIT 20"))
def latest_batches(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.latest_rows(aggregates.batch_monitor(inputs.fact(spark, sf)), F.desc("etl_batch_id"))


@query(
    sql(
        "fact",
        """SELECT f.sale_id, f.payment_method, f.total_amount, p.payment_display_name, p.is_digital FROM fact f LEFT JOIN (
  VALUES ('credit', 'Credit Card', true), ('cash', 'Cash', false), ('debit', 'Debit Card', true))
  p(payment_method, payment_display_name, is_digital) ON f.payment_method = p.payment_method""",
    )
)
def sales_with_payment(spark: SparkSession, sf: str) -> DataFrame:
    joined = aggregates.sales_with_payment(inputs.fact(spark, sf), payment_methods(spark))
    return joined.select("sale_id", "payment_method", "total_amount", "payment_display_name", "is_digital")


def payment_methods(spark: SparkSession) -> DataFrame:
    """The payment-method seed."""
    return files.read_seed(spark, files.shipped(spark, "payment_methods.csv"))


@query(
    sql(
        "stores",
        f"SELECT d.region AS store_region, {money('sum(f.total_amount)')} AS revenue, count(*) AS sale_count "
        "FROM fact f JOIN stores d ON f.store_id = d.store_id GROUP BY d.region",
    )
)
def revenue_by_dim(spark: SparkSession, sf: str) -> DataFrame:
    fact = inputs.fact(spark, sf)
    return aggregates.revenue_by_dimension(fact, aggregates.dim_stores(fact, inputs.AS_OF))


@query(
    sql(
        "daily",
        """SELECT s.sale_date, r.region, coalesce(d.order_count, 0) AS order_count,
  coalesce(d.net_revenue, CAST(0 AS DECIMAL(18,2))) AS net_revenue
FROM (SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS DATE) AS sale_date FROM daily) s
CROSS JOIN (SELECT DISTINCT region FROM daily) r
LEFT JOIN daily d ON d.sale_date = s.sale_date AND d.region = r.region""",
        completed_only=True,
    )
)
def gap_fill_daily(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.gap_filled_daily(aggregates.daily_sales(inputs.fact(spark, sf, completed_only=True), inputs.AS_OF))


@query(
    sql(
        "fact",
        "SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, "
        + ", ".join(
            f"count(*) FILTER (WHERE region = '{r}') AS {r.lower().replace(' ', '_')}_orders" for r in REGIONS
        )
        + " FROM fact GROUP BY 1",
    )
)
def region_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.region_pivot(inputs.fact(spark, sf), REGIONS)


@query(
    sql(
        "daily",
        " UNION ALL ".join(
            f"SELECT sale_date, region, '{m}' AS measure, CAST({m} AS DECIMAL(18,2)) AS value FROM daily"
            for m in ("order_count", "total_units_sold", "net_revenue", "gross_profit")
        ),
    )
)
def kpi_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    daily = aggregates.daily_sales(inputs.fact(spark, sf), inputs.AS_OF)
    return aggregates.kpi_unpivot(daily, ["order_count", "total_units_sold", "net_revenue", "gross_profit"])


@query(
    sql(
        "daily",
        f"""SELECT sale_date, region, {money('sum(net_revenue) OVER (PARTITION BY region ORDER BY sale_date '
        'RANGE BETWEEN INTERVAL 27 DAYS PRECEDING AND CURRENT ROW)')} AS net_revenue_28d FROM daily""",
    )
)
def cumulative_28d(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.cumulative_revenue(aggregates.daily_sales(inputs.fact(spark, sf), inputs.AS_OF), 28)


@query(
    sql(
        "fact",
        f"""SELECT *, {quotient(cents('revenue'), 'CAST(order_count AS HUGEINT)', 'DECIMAL(18,2)')} AS revenue_per_order,
  {quotient(cents('profit') + ' * 10000', cents('revenue'), 'DECIMAL(18,2)')} AS profit_margin_pct
FROM (SELECT region, {money('sum(net_amount)')} AS revenue, {money('sum(gross_profit)')} AS profit,
  count(*) AS order_count FROM fact GROUP BY region) s""",
    )
)
def revenue_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.revenue_metrics(inputs.fact(spark, sf))


@query(
    f"""SELECT *, CASE WHEN base_users > 0 THEN
  {quotient('CAST(converted_users AS HUGEINT) * 10000', 'CAST(base_users AS HUGEINT)', 'DECIMAL(18,2)')} END AS conversion_pct
FROM (SELECT day, count(*) FILTER (WHERE b) AS base_users, count(*) FILTER (WHERE b AND g) AS converted_users
  FROM (SELECT CAST(ts AS DATE) AS day, user_id, bool_or(event_type = 'view') AS b, bool_or(event_type = 'purchase') AS g
    FROM events GROUP BY 1, 2) u GROUP BY day) c"""
)
def conversion_rate(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.conversion_rate(events(spark, sf))


@query(
    sql(
        "merged",
        """SELECT etl_batch_id, count(*) FILTER (WHERE created_at = updated_at) AS inserts,
  count(*) FILTER (WHERE created_at <> updated_at) AS updates FROM merged GROUP BY etl_batch_id""",
    )
)
def insert_update_tally(spark: SparkSession, sf: str) -> DataFrame:
    table_after = cdc_merge(inputs.old_fact(spark, sf), inputs.changes(spark, sf), inputs.AS_OF)
    return aggregates.insert_update_tally(table_after)
