"""Daily KPIs kept up to date from what a merge changed.

The state holds, per day and region, sums and counts that can be added to and
taken from (``total`` rows), and how many sales each customer, store and batch
has there (one row each). A merge's rows enter with a sign: what they were is
subtracted, what they have become is added. Distinct counts and the newest batch
follow from the rows whose count is above zero, so no sale is looked at again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import SIGN
from tidemark.schemas import PAYMENT_METHODS

# What is summed, and its column in the fact.
MEASURES = {
    "total_units_sold": "quantity",
    "gross_revenue": "total_amount",
    "total_discounts": "discount_amount",
    "total_tax": "tax_amount",
    "net_revenue": "net_amount",
    "gross_profit": "gross_profit",
}
COUNTED = {"customer": "customer_id", "store": "store_id", "batch": "etl_batch_id"}
# What of a sale the state depends on.
SOURCE_COLUMNS = ["sale_date", "region", "payment_method", *MEASURES.values(), *COUNTED.values()]
KEYS = ["sale_date", "region", "kind", "value"]
ADDED = ["n", *MEASURES, *[f"{name}_known" for name in MEASURES], *[f"{method}_orders" for method in PAYMENT_METHODS]]
MONTH = "state_month"
STATE_DDL = ", ".join(
    [
        "sale_date date, region string, kind string, value string, n bigint",
        *[f"{name} decimal(28,2)" for name in MEASURES],
        *[f"{name}_known bigint" for name in MEASURES],
        *[f"{method}_orders bigint" for method in PAYMENT_METHODS],
        f"_aggregated_at timestamp_ntz, {MONTH} int",
    ]
)
DAILY_DDL = (
    "sale_date date, region string, order_count bigint, total_units_sold bigint, unique_customers bigint, active_stores bigint, "
    "gross_revenue decimal(18,2), total_discounts decimal(18,2), total_tax decimal(18,2), net_revenue decimal(18,2), "
    "gross_profit decimal(18,2), avg_order_value decimal(10,2), avg_units_per_order decimal(10,2), "
    + ", ".join(f"{method}_orders bigint" for method in PAYMENT_METHODS)
    + f", latest_batch_id string, _aggregated_at timestamp_ntz, {MONTH} int"
)
DAILY_COLUMNS = [part.split()[0] for part in DAILY_DDL.replace("(18,2)", "").replace("(10,2)", "").split(", ")][:-1]


def month_of(day: str = "sale_date") -> Column:
    """The month of a day as yyyymm, by which state and KPIs are stored."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def _summed(rows: DataFrame) -> DataFrame:
    """Rows of one key added up; those that nothing is left of disappear."""
    added = {f.name: f.dataType for f in rows.schema if f.name in ADDED}
    sums = [F.sum(name).cast("decimal(28,2)" if name in MEASURES else "bigint").alias(name) for name in added]
    together = rows.groupBy(*KEYS).agg(*sums, F.max("_aggregated_at").alias("_aggregated_at"))
    return together.filter(F.col("n") != 0).withColumn(MONTH, month_of())


def _total(sign: Column) -> list[Column]:
    """The fields of a ``total`` row of one sale."""
    amounts = [(sign * F.col(source)).cast("decimal(28,2)").alias(name) for name, source in MEASURES.items()]
    known = [F.when(F.col(source).isNotNull(), sign).otherwise(0).cast("bigint").alias(f"{name}_known") for name, source in MEASURES.items()]
    paid = [F.when(F.col("payment_method") == method, sign).otherwise(0).cast("bigint").alias(f"{method}_orders") for method in PAYMENT_METHODS]
    return [*amounts, *known, *paid]


def _nothing() -> list[Column]:
    return [F.lit(None).cast("decimal(28,2)" if name in MEASURES else "bigint").alias(name) for name in ADDED[1:]]


def state_changes(signed: DataFrame, as_of: dt.datetime) -> DataFrame:
    """State rows of signed fact rows (``signed_images``), pre-aggregated before their shuffle."""
    sign = F.col(SIGN).cast("bigint")
    text = F.lit(None).cast("string")
    rows = [F.struct(F.lit("total").alias("kind"), text.alias("value"), sign.alias("n"), *_total(sign))]
    for kind, column in COUNTED.items():
        rows.append(F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value"), sign.alias("n"), *_nothing()))
    spread = signed.select(F.to_date("sale_date").alias("sale_date"), "region", F.inline(F.array(*rows)))
    told = spread.filter((F.col("kind") == "total") | F.col("value").isNotNull())
    sums = [F.sum(name).cast("decimal(28,2)" if name in MEASURES else "bigint").alias(name) for name in ADDED]
    stamped = told.groupBy(*KEYS).agg(*sums)
    return stamped.withColumns({"_aggregated_at": F.lit(as_of).cast("timestamp_ntz"), MONTH: month_of()})


def combined(states: Sequence[DataFrame]) -> DataFrame:
    """State rows of several frames added up."""
    first, *others = states
    for other in others:
        first = first.unionByName(other)
    return _summed(first)


def daily_of_state(state: DataFrame) -> DataFrame:
    """The KPIs per day and region that a state amounts to."""
    total = F.col("kind") == "total"

    def of_total(name: str) -> Column:
        return F.max(F.when(total, F.col(name)))

    def amount(name: str, kind: str) -> Column:
        return F.when(of_total(f"{name}_known") > 0, of_total(name)).cast(kind)

    def average(name: str) -> Column:
        whole = F.nullif(of_total(f"{name}_known"), F.lit(0))
        return (of_total(name).cast("decimal(20,2)") / whole).cast("decimal(10,2)")

    batches = F.max(F.when(F.col("kind") == "batch", F.col("value").cast("bigint")))
    return state.groupBy("sale_date", "region").agg(
        of_total("n").alias("order_count"),
        amount("total_units_sold", "bigint").alias("total_units_sold"),
        F.count_if(F.col("kind") == "customer").alias("unique_customers"),
        F.count_if(F.col("kind") == "store").alias("active_stores"),
        *[amount(name, "decimal(18,2)").alias(name) for name in MEASURES if name != "total_units_sold"],
        average("gross_revenue").alias("avg_order_value"),
        average("total_units_sold").alias("avg_units_per_order"),
        *[of_total(f"{method}_orders").alias(f"{method}_orders") for method in PAYMENT_METHODS],
        batches.cast("string").alias("latest_batch_id"),
        of_total("_aggregated_at").alias("_aggregated_at"),
        F.first(MONTH).alias(MONTH),
    )
