"""Declared schemas, column lists and value domains.

Every table has exactly one declaration here; rows are always matched to it
by name, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values -----------------------------------------------------------
COMPLETED = "completed"
CHANGE_CODES = {"c": "create", "u": "update", "d": "delete", "r": "snapshot read"}
REGION_NAMES = {
    "us_east": "US-EAST",
    "us_west": "US-WEST",
    "europe": "EUROPE",
    "asia_pacific": "ASIA-PACIFIC",
}
PAYMENT_METHODS = ["credit", "cash", "debit"]
NULL_TOKENS = ["NULL", "null", ""]
MIN_RECORD_COUNT = 100
MAX_NULL_PERCENTAGE = 5.0
# Share of a batch's live rows that may fail the row rules before the batch as a whole is stopped.
MAX_FAILING_PERCENTAGE = 10.0
CRITICAL_COLUMNS = ["sale_id", "customer_id", "product_id", "sale_date", "total_amount"]
REQUIRED_COLUMNS = [
    "sale_id",
    "customer_id",
    "product_id",
    "sale_date",
    "quantity",
    "unit_price",
    "total_amount",
    "region",
]
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
FRESHNESS_WARN_HOURS = 2
FRESHNESS_ERROR_HOURS = 6
# ----------------------------------------------------------------------------

_TYPES = {
    "sale_id": "bigint",
    "customer_id": "string",
    "product_id": "string",
    "store_id": "string",
    "sale_date": "timestamp_ntz",
    "created_at": "timestamp_ntz",
    "updated_at": "timestamp_ntz",
    "quantity": "int",
    "unit_price": "decimal(10,2)",
    "total_amount": "decimal(10,2)",
    "discount_amount": "decimal(10,2)",
    "tax_amount": "decimal(10,2)",
    "net_amount": "decimal(10,2)",
    "gross_profit": "decimal(10,2)",
    "region": "string",
    "payment_method": "string",
    "status": "string",
    "is_deleted": "boolean",
    "sale_year": "int",
    "sale_month": "int",
    "sale_day": "int",
    "etl_loaded_at": "timestamp_ntz",
    "etl_batch_id": "string",
    "_cdc_operation": "string",
    "_cdc_source_ts": "timestamp_ntz",
    "_kafka_offset": "bigint",
    "_row_inserted_at": "timestamp_ntz",
    "_row_updated_at": "timestamp_ntz",
}


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"`{name}` {_TYPES[name]}" for name in columns)


def schema_of(columns: list[str]) -> StructType:
    """The declared schema of a column list."""
    return StructType.fromDDL(_ddl(columns))


# A row as the transactional source holds it.
SOURCE_COLUMNS = [
    "sale_id",
    "customer_id",
    "product_id",
    "sale_date",
    "quantity",
    "unit_price",
    "total_amount",
    "store_id",
    "payment_method",
    "discount_amount",
    "tax_amount",
    "created_at",
    "updated_at",
    "is_deleted",
]
CHANGE_EVENT_COLUMNS = [*SOURCE_COLUMNS, "status"]
EXTRACT_COLUMNS = [*SOURCE_COLUMNS, "region", "etl_batch_id"]

# A row ready to merge: typed and derived, live rows and delete markers mixed.
STAGE_COLUMNS = [
    "sale_id",
    "customer_id",
    "product_id",
    "sale_date",
    "quantity",
    "unit_price",
    "total_amount",
    "region",
    "store_id",
    "payment_method",
    "discount_amount",
    "tax_amount",
    "net_amount",
    "gross_profit",
    "sale_year",
    "sale_month",
    "sale_day",
    "created_at",
    "updated_at",
    "is_deleted",
    "etl_loaded_at",
    "etl_batch_id",
    "_cdc_operation",
    "_cdc_source_ts",
    "_kafka_offset",
]

STAGING_MODEL_COLUMNS = [
    "sale_id",
    "customer_id",
    "product_id",
    "store_id",
    "sale_date",
    "created_at",
    "updated_at",
    "quantity",
    "unit_price",
    "total_amount",
    "discount_amount",
    "tax_amount",
    "region",
    "payment_method",
    "is_deleted",
    "_cdc_operation",
    "_cdc_source_ts",
    "etl_batch_id",
    "etl_loaded_at",
]

DELETE_MARKER_COLUMNS = [
    "sale_id",
    "region",
    "updated_at",
    "_cdc_operation",
    "_cdc_source_ts",
    "etl_batch_id",
]

FACT_COLUMNS = [
    "sale_id",
    "customer_id",
    "product_id",
    "store_id",
    "sale_date",
    "created_at",
    "updated_at",
    "quantity",
    "unit_price",
    "total_amount",
    "discount_amount",
    "tax_amount",
    "net_amount",
    "gross_profit",
    "region",
    "payment_method",
    "sale_year",
    "sale_month",
    "sale_day",
    "_cdc_operation",
    "_cdc_source_ts",
    "etl_batch_id",
    "etl_loaded_at",
    "_row_inserted_at",
    "_row_updated_at",
]

# Kept from the first version of a fact row when the row is updated.
INSERT_ONLY_COLUMNS = ["sale_id", "created_at", "_row_inserted_at"]

REGION_CONFIG_DDL = (
    "name string, conn_id string, display_name string, timezone string, "
    "extraction_timeout_minutes int, retries int"
)
PAYMENT_METHOD_DDL = "payment_method string, display_name string, is_digital boolean"


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select ``columns`` by name with their declared types; absent ones are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(_TYPES[name]).alias(name)
            for name in columns
        ]
    )
