"""Registered queries: sources, projections, filters, row rules, dedup, unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import dedup, enrich, gate, staging
from tidemark.plans import inputs
from tidemark.plans.oracle import CONTENT, DATA_LIST, REJECTED_COUNT, REJECTED_ROWS, sql
from tidemark.plans.registry import query
from tidemark.schemas import FACT_COLUMNS, SOURCE_COLUMNS, schema_of
from tidemark.session import fresh_path
from tidemark.sinks import partitions
from tidemark.sources import extract, files
from tidemark.sources.tables import REGIONS, events, table
from tidemark.streaming import envelope

DAY = dt.date(1998, 6, 2)
_SOURCE_LIST = ", ".join(SOURCE_COLUMNS)
_IN_DAY = "updated_at >= TIMESTAMP '1998-06-01' AND updated_at < TIMESTAMP '1998-06-02' AND status = 'completed'"
# Codes of four regions; the fifth stays unknown on purpose.
LABELS = {"africa": "AFRICA", "america": "AMERICA", "asia": "ASIA", "europe": "EUROPE"}


def _code() -> F.Column:
    return F.lower(F.replace("region", F.lit(" "), F.lit("_")))


@query(sql("sales", f"SELECT {_SOURCE_LIST} FROM sales WHERE {_IN_DAY}"))
def extract_window(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_window(inputs.sales(spark, sf), DAY)


@query(
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 1 AS TIMESTAMP) AS window_start, "
    "CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS window_end, strftime(o_orderdate, '%Y%m%d') AS batch_id FROM orders"
)
def batch_windows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", *fn.batch_window_columns("o_orderdate"))


@query(sql("sales", f"SELECT {_SOURCE_LIST}, region, '19980602' AS etl_batch_id FROM sales WHERE {_IN_DAY}"))
def consolidate_regions(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.sales(spark, sf)
    return extract.extract_regions({region: rows.filter(F.col("region") == region) for region in REGIONS}, DAY)


@query(sql("fact", "SELECT * FROM fact WHERE etl_batch_id = '199806'"))
def batch_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One batch of a table stored by batch: no other batch is read."""
    path = fresh_path(spark, "by-batch")
    partitions.replace_slices(inputs.fact(spark, sf), path, ["etl_batch_id"])
    return extract.read_batch(spark, path, "199806", schema_of(FACT_COLUMNS)).select(*FACT_COLUMNS)


@query(
    "SELECT event_id, user_id, date_trunc('milliseconds', ts) AS source_ts, "
    "CAST(value AS DECIMAL(10,2)) AS amount FROM events"
)
def wire_decoding(spark: SparkSession, sf: str) -> DataFrame:
    sent = events(spark, sf).withColumn("ts_ms", fn.epoch_millis(F.col("ts")))
    return sent.select(
        "event_id",
        "user_id",
        fn.wire_timestamp(F.col("ts_ms").cast("string")).alias("source_ts"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
    )


@query(
    "SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders"
)
def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    bounds = table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_day"))


# --- envelopes ---------------------------------------------------------------
@query(sql("parsed", "SELECT * FROM parsed"))
def parse_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.staged_events(spark, sf)


@query(
    sql(
        "delivered",
        "SELECT _kafka_offset, sale_id, region, ms AS updated_at FROM delivered",
    )
)
def envelope_fallback(spark: SparkSession, sf: str) -> DataFrame:
    opened = envelope.usable(envelope.open_envelopes(inputs.raw_events(spark, sf)))
    return opened.select(
        "_kafka_offset",
        envelope.after_or_before("sale_id").alias("sale_id"),
        fn.region_label(envelope.region_code()).alias("region"),
        fn.wire_timestamp(envelope.after_or_before("updated_at")).alias("updated_at"),
    )


@query(
    sql(
        "delivered",
        "SELECT op, (op = 'd' OR k % 11 = 0) AS is_deleted, count(*) AS event_count FROM delivered GROUP BY 1, 2",
    )
)
def delete_flag(spark: SparkSession, sf: str) -> DataFrame:
    opened = envelope.usable(envelope.open_envelopes(inputs.raw_events(spark, sf)))
    flagged = opened.select(F.col("e.op").alias("op"), envelope.delete_flag().alias("is_deleted"))
    return flagged.groupBy("op", "is_deleted").agg(F.count(F.lit(1)).alias("event_count"))


@query(sql("log", REJECTED_ROWS))
def quarantine_malformed(spark: SparkSession, sf: str) -> DataFrame:
    return envelope.dead_letters(inputs.raw_events(spark, sf)).select("_kafka_offset", "rejection_reason")


@query(
    sql(
        "log",
        "SELECT 'cdc.sales' AS _kafka_topic, CAST(event_id % 4 AS INTEGER) AS _kafka_partition, "
        "count(*) + count(*) FILTER (WHERE event_id % 10 = 0) + count(*) FILTER (WHERE event_id % 9 = 0) "
        f"+ count(*) FILTER (WHERE op = 'd') + {REJECTED_COUNT} AS record_count FROM log GROUP BY 2",
    )
)
def topic_routing(spark: SparkSession, sf: str) -> DataFrame:
    routed = envelope.route_topic(inputs.raw_events(spark, sf), r"^cdc\.retail\.sales\..*$", "cdc.sales")
    return routed.groupBy("_kafka_topic", "_kafka_partition").agg(F.count(F.lit(1)).alias("record_count"))


# --- typing, defaults, derived columns ----------------------------------------
@query(
    sql(
        "sales",
        "SELECT sale_id, total_amount, coalesce(discount_amount, CAST(0 AS DECIMAL(10,2))) AS discount_amount, "
        "coalesce(tax_amount, CAST(0 AS DECIMAL(10,2))) AS tax_amount FROM sales",
    )
)
def null_defaults(spark: SparkSession, sf: str) -> DataFrame:
    filled = staging.default_amounts(inputs.sales(spark, sf))
    return filled.select("sale_id", "total_amount", "discount_amount", "tax_amount")


@query(sql("staged", "SELECT * FROM staged"))
def typed_staging(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_transactions(inputs.sales(spark, sf))


@query(sql("checked", "SELECT sale_id, total_amount, discount_amount, tax_amount, net_amount, gross_profit FROM checked"))
def enrich_amounts(spark: SparkSession, sf: str) -> DataFrame:
    derived = enrich.derive_amounts(staging.stage_transactions(inputs.sales(spark, sf)))
    return derived.select("sale_id", "total_amount", "discount_amount", "tax_amount", "net_amount", "gross_profit")


@query(sql("checked", "SELECT sale_id, sale_year, sale_month, sale_day FROM checked"))
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    derived = enrich.derive_date_parts(staging.stage_transactions(inputs.sales(spark, sf)))
    return derived.select("sale_id", "sale_year", "sale_month", "sale_day")


@query(
    sql(
        "sales",
        "SELECT sale_id, updated_at, product_id, CASE WHEN region <> 'MIDDLE EAST' THEN region END AS region FROM sales",
    )
)
def region_normalise(spark: SparkSession, sf: str) -> DataFrame:
    coded = inputs.sales(spark, sf).withColumn("region", _code())
    return staging.normalise_region(coded, LABELS).select("sale_id", "updated_at", "product_id", "region")


@query(
    sql(
        "sales",
        "SELECT s.sale_id, s.updated_at, s.product_id, n.r_name AS region FROM sales s "
        "LEFT JOIN region n ON s.region = n.r_name",
    )
)
def region_join(spark: SparkSession, sf: str) -> DataFrame:
    names = files.read_region_config(spark, files.shipped(spark, "regions.json"))
    coded = inputs.sales(spark, sf).withColumn("region", _code())
    return files.with_region_names(coded, names).select("sale_id", "updated_at", "product_id", "region")


@query(sql("sales", "SELECT sale_id, updated_at, TIMESTAMP '2001-08-01' AS etl_loaded_at, '20010801' AS etl_batch_id FROM sales"))
def load_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = staging.stamp_load(inputs.sales(spark, sf), inputs.AS_OF, "20010801")
    return stamped.select("sale_id", "updated_at", "etl_loaded_at", "etl_batch_id")


# --- row rules ------------------------------------------------------------------
@query(
    sql(
        "sales",
        "SELECT sale_id, quantity, unit_price, total_amount FROM sales "
        "WHERE quantity > 0 AND unit_price > 0 AND total_amount > 0",
    )
)
def row_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = staging.positive_rows(inputs.sales(spark, sf))
    return kept.select("sale_id", "quantity", "unit_price", "total_amount")


@query(sql("checked", "SELECT sale_id, quantity, unit_price, total_amount, is_amount_valid FROM checked"))
def amount_validity(spark: SparkSession, sf: str) -> DataFrame:
    enriched = enrich.enrich(staging.stage_transactions(inputs.sales(spark, sf)))
    return enriched.select("sale_id", "quantity", "unit_price", "total_amount", "is_amount_valid")


@query(
    sql(
        "parsed",
        "SELECT _kafka_offset, sale_id, CASE WHEN quantity <= 0 THEN 'invalid_quantity' WHEN unit_price <= 0 THEN 'invalid_price' "
        "WHEN total_amount <= 0 THEN 'invalid_amount' "
        "WHEN NOT coalesce(total_amount >= quantity * unit_price * 0.5 AND total_amount <= quantity * unit_price * 2.0, false) "
        "THEN 'failed_amount_sanity' WHEN customer_id IS NULL THEN 'missing_customer' "
        "WHEN product_id IS NULL THEN 'missing_product' END AS validation_failure_reason FROM parsed",
    )
)
def validation_reason(spark: SparkSession, sf: str) -> DataFrame:
    enriched = inputs.staged_events(spark, sf).withColumn("is_amount_valid", fn.amount_is_plausible())
    return enrich.with_reason(enriched).select("_kafka_offset", "sale_id", "validation_failure_reason")


@query(sql("checked", "SELECT * FROM checked WHERE validation_failure_reason IS NULL"))
def validated(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.validated(spark, sf)


@query(sql("checked", "SELECT * FROM checked WHERE validation_failure_reason IS NOT NULL"))
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.quarantined(inputs.checked(inputs.sales(spark, sf)))


@query(sql("sales", "SELECT * FROM sales WHERE NOT is_deleted"))
def cdc_split_live(spark: SparkSession, sf: str) -> DataFrame:
    return staging.split_live(inputs.sales(spark, sf))


@query(
    sql(
        "sales",
        "SELECT DISTINCT sale_id, region, updated_at, _cdc_operation, _cdc_source_ts, etl_batch_id FROM sales "
        "WHERE is_deleted AND etl_batch_id IS NOT NULL",
    )
)
def cdc_delete_markers(spark: SparkSession, sf: str) -> DataFrame:
    return staging.delete_markers(inputs.sales(spark, sf))


_MARKERS = """SELECT DISTINCT sale_id, region, updated_at, _cdc_operation, _cdc_source_ts, etl_batch_id
  FROM sales WHERE is_deleted AND etl_batch_id IS NOT NULL"""


@query(
    sql(
        "fact",
        f"SELECT {DATA_LIST} FROM fact UNION ALL BY NAME ({_MARKERS})",
    )
)
def union_live_deletes(spark: SparkSession, sf: str) -> DataFrame:
    live = inputs.fact(spark, sf).drop("_row_inserted_at", "_row_updated_at")
    return staging.union_live_and_markers(live, staging.delete_markers(inputs.sales(spark, sf)))


@query(
    sql(
        "sales",
        f"""SELECT sale_id, customer_id, product_id, sale_date, quantity, unit_price, total_amount, store_id,
  payment_method, coalesce(discount_amount, CAST(0 AS DECIMAL(10,2))) AS discount_amount,
  coalesce(tax_amount, CAST(0 AS DECIMAL(10,2))) AS tax_amount, created_at, updated_at, is_deleted,
  CASE WHEN region <> 'MIDDLE EAST' THEN region END AS region, 'b1' AS etl_batch_id, TIMESTAMP '2001-08-01' AS etl_loaded_at,
  CAST(total_amount - coalesce(discount_amount, 0) AS DECIMAL(10,2)) AS net_amount,
  CAST(total_amount - coalesce(discount_amount, 0) - coalesce(tax_amount, 0) AS DECIMAL(10,2)) AS gross_profit,
  CAST(year(sale_date) AS INTEGER) AS sale_year, CAST(month(sale_date) AS INTEGER) AS sale_month,
  CAST(day(sale_date) AS INTEGER) AS sale_day
FROM (SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY updated_at DESC NULLS LAST,
    {CONTENT.replace(", _cdc_operation NULLS LAST", "")}) AS rn FROM sales WHERE NOT is_deleted) r
WHERE rn = 1 AND quantity > 0 AND unit_price > 0 AND total_amount > 0
UNION ALL BY NAME
SELECT sale_id, customer_id, product_id, sale_date, quantity, unit_price, total_amount, store_id, payment_method,
  discount_amount, tax_amount, created_at, updated_at, is_deleted,
  CASE WHEN region <> 'MIDDLE EAST' THEN region END AS region, 'b1' AS etl_batch_id, TIMESTAMP '2001-08-01' AS etl_loaded_at
FROM sales WHERE is_deleted""",
    )
)
def batch_transform(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.sales(spark, sf).withColumn("region", _code()).select(*SOURCE_COLUMNS, "region", "etl_batch_id")
    return staging.transform_batch(rows, inputs.AS_OF, "b1", LABELS)


@query(
    sql(
        "sales",
        f"""SELECT 'b1' AS etl_batch_id, count(*) AS total_extracted,
  count(*) FILTER (WHERE NOT is_deleted) - count(DISTINCT sale_id) FILTER (WHERE NOT is_deleted) AS duplicates_removed,
  count(*) FILTER (WHERE is_deleted) AS delete_markers,
  (SELECT count(*) FROM (SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY updated_at DESC NULLS LAST,
     {CONTENT.replace(", _cdc_operation NULLS LAST", "")}) AS rn FROM sales WHERE NOT is_deleted) r
   WHERE rn = 1 AND quantity > 0 AND unit_price > 0 AND total_amount > 0) AS transformed_records,
  'success' AS status FROM sales""",
    )
)
def transform_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.sales(spark, sf).withColumn("region", _code()).select(*SOURCE_COLUMNS, "region", "etl_batch_id")
    return gate.transform_metrics(rows, staging.transform_batch(rows, inputs.AS_OF, "b1", LABELS), "b1")


# --- latest per key -----------------------------------------------------------
@query(sql("latest_event", "SELECT * FROM latest_event"))
def latest_event_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_event_per_key(inputs.staged_events(spark, sf))


@query(
    sql(
        "sales",
        f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sale_id
  ORDER BY updated_at DESC NULLS LAST, _cdc_source_ts DESC NULLS LAST, {CONTENT}) AS rn FROM sales WHERE NOT is_deleted) r
WHERE rn = 1""",
    )
)
def latest_live_row(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_live_row(staging.split_live(inputs.sales(spark, sf)))


# --- scalar functions -----------------------------------------------------------
@query(
    "SELECT c_custkey, md5(coalesce(c_mktsegment, '_dbt_utils_surrogate_key_null_')) AS segment_key, "
    "md5(coalesce(CAST(c_custkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' || "
    "coalesce(c_name, '_dbt_utils_surrogate_key_null_')) AS customer_key, "
    "md5('_dbt_utils_surrogate_key_null_') AS missing_key FROM customer"
)
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        fn.surrogate_key("c_mktsegment").alias("segment_key"),
        fn.surrogate_key("c_custkey", "c_name").alias("customer_key"),
        fn.surrogate_key(F.lit(None)).alias("missing_key"),
    )


@query(
    "SELECT o_orderkey, CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(20,0)) * "
    "CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS dollars FROM orders"
)
def cents_to_dollars(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return table(spark, sf, "orders").select("o_orderkey", fn.cents_to_dollars(cents).alias("dollars"))


@query(
    sql(
        "sales",
        "SELECT sale_id, updated_at, product_id, CAST(total_amount + coalesce(discount_amount, 0) + coalesce(tax_amount, 0) "
        "AS DECIMAL(18,2)) AS listed_amount FROM sales",
    )
)
def safe_add(spark: SparkSession, sf: str) -> DataFrame:
    listed = fn.safe_add("total_amount", "discount_amount", "tax_amount").cast("decimal(18,2)")
    return inputs.sales(spark, sf).select("sale_id", "updated_at", "product_id", listed.alias("listed_amount"))
