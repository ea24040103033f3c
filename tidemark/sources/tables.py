"""Sales rows seen through the given order and line-item tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import COMPLETED

# --- fixed values: how coded columns of the tables read as sales columns -----
PAYMENT_BY_PRIORITY = {"1-URGENT": "credit", "2-HIGH": "cash", "3-MEDIUM": "debit"}
STATUS_BY_CODE = {"F": COMPLETED, "O": "open"}
OPERATION_BY_FLAG = {"N": "c", "A": "u", "R": "d"}
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _recode(column: str, codes: dict[str, str], otherwise: str | None) -> Column:
    value = F.lit(otherwise)
    for code, text in reversed(codes.items()):
        value = F.when(F.col(column) == code, text).otherwise(value)
    return value


def _share_of_price(rate: str) -> Column:
    """A rate of the price in money; no rate at all is a missing value."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    amount = (price * F.col(rate).cast("decimal(4,2)")).cast("decimal(10,2)")
    return F.when(F.col(rate) != 0, amount)


def sales_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a sales row, live or deleted.

    A sale id can occur several times: these are successive versions of it.
    The joins are plain equi joins; Spark broadcasts small sides by their known
    size and splits skewed shuffle partitions at run time. Customers join the
    orders first, so that the largest table is not shuffled for them.
    """
    lines, orders, parts = (table(spark, sf_dir, name) for name in ("lineitem", "orders", "part"))
    customers, nations, regions = (table(spark, sf_dir, name) for name in ("customer", "nation", "region"))
    placed = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "r_name")
    )
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("o_orderdate").alias("sale_date"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total_amount"),
        _share_of_price("l_discount").alias("discount_amount"),
        _share_of_price("l_tax").alias("tax_amount"),
        F.col("r_name").alias("region"),
        _recode("o_orderpriority", PAYMENT_BY_PRIORITY, "other").alias("payment_method"),
        _recode("o_orderstatus", STATUS_BY_CODE, "pending").alias("status"),
        (F.col("l_returnflag") == "R").alias("is_deleted"),
        _recode("l_returnflag", OPERATION_BY_FLAG, None).alias("_cdc_operation"),
        F.col("l_shipdate").alias("_cdc_source_ts"),
        F.date_format("l_shipdate", "yyyyMM").alias("etl_batch_id"),
        F.col("l_shipdate").alias("etl_loaded_at"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log."""
    return table(spark, sf_dir, "events")
