"""A raw change-event log derived from the given event table.

Each event becomes a change of one sale (its user) as a capture connector
would send it: a JSON envelope with before and after images. The log also
carries what such logs carry in practice, again derived from every event by
rule: redelivered records, late copies of older changes, tombstones after
deletes, and records no parser accepts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import epoch_millis
from tidemark.sources.tables import events

# --- fixed values -----------------------------------------------------------
OPERATION_BY_EVENT = {"signup": "r", "view": "c", "click": "u", "purchase": "u", "error": "d"}
EVENT_REGIONS = ["us_east", "us_west", "europe", "asia_pacific"]
METHOD_BY_REMAINDER = ["credit", "cash", "debit"]
TOPIC = "cdc.retail.sales.transactions"
PARTITIONS = 4
LATE_OFFSET = 1_000_000_000_000  # offsets of late copies start here
# ----------------------------------------------------------------------------


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _operation() -> Column:
    op = F.lit(None)
    for name, code in OPERATION_BY_EVENT.items():
        op = F.when(F.col("event_type") == name, code).otherwise(op)
    return op


def change_log(spark: SparkSession, sf_dir: str, noise: bool = True) -> DataFrame:
    """The raw landing rows: record, topic, partition, offset, arrival time."""
    k = F.get_json_object("props", "$.k").cast("int")
    millis = epoch_millis(F.col("ts"))
    base = events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.col("user_id").alias("sale_id"),
        _operation().alias("op"),
        k.alias("k"),
        F.col("value").cast("decimal(10,2)").alias("price"),
        millis.alias("ts_ms"),
    )
    created = epoch_millis(
        F.lit(dt.datetime(2023, 12, 31)).cast("timestamp_ntz")
        + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("sale_id").cast("decimal(18,6)"))
    )
    quantity = F.col("k") % 7
    after = F.struct(
        "sale_id",
        F.concat(F.lit("C"), F.col("sale_id")).alias("customer_id"),
        F.concat(F.lit("P"), F.col("k")).alias("product_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("sale_date"),
        quantity.alias("quantity"),
        F.col("price").cast("double").alias("unit_price"),
        (F.col("price") * quantity).cast("decimal(10,2)").cast("double").alias("total_amount"),
        F.concat(F.lit("S"), F.col("sale_id") % 20).alias("store_id"),
        _pick(METHOD_BY_REMAINDER, F.col("k") % 3).alias("payment_method"),
        F.when(F.col("k") % 4 != 0, (F.col("k") / F.lit(100)).cast("decimal(10,2)").cast("double")).alias("discount_amount"),
        F.when(F.col("k") % 5 != 0, (F.col("k") / F.lit(200)).cast("decimal(10,2)").cast("double")).alias("tax_amount"),
        created.cast("string").alias("created_at"),
        F.when(F.col("k") % 2 == 0, F.col("ts_ms").cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .alias("updated_at"),
        F.when(F.col("k") % 11 == 0, True).when(F.col("k") % 11 < 9, False).alias("is_deleted"),
        F.when(F.col("k") % 13 == 0, "pending").otherwise("completed").alias("status"),
    )
    before = F.struct("sale_id", F.col("ts_ms").cast("string").alias("updated_at"))
    envelope = F.struct(
        F.when(F.col("op") != "d", after).alias("after"),
        F.when(F.col("op").isin("u", "d"), before).alias("before"),
        "op",
        "ts_ms",
        _pick(EVENT_REGIONS, F.col("sale_id") % 4).alias("region"),
    )
    log = base.select(
        "event_id",
        "ts",
        "op",
        F.to_json(envelope, {"ignoreNullFields": "false"}).alias("record_content"),
        F.lit(TOPIC).alias("_kafka_topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("_kafka_partition"),
        F.col("event_id").alias("_kafka_offset"),
        F.col("ts").alias("_kafka_timestamp"),
    )
    if noise:
        log = _with_noise(log)
    return log.drop("event_id", "ts", "op")


def _with_noise(log: DataFrame) -> DataFrame:
    """Add, per matching event, the records a real log holds besides the clean ones."""

    def every(number: int) -> Column:
        return F.col("event_id") % number == 0

    def replaced(pattern: str, value: str) -> Column:
        return F.regexp_replace("record_content", pattern, value)

    rejected = [
        (every(17), F.expr("left(record_content, length(record_content) - 1)")),
        (every(19), replaced('"ts_ms":[0-9]+', '"ts_ms":"late"')),
        (every(23) & (F.col("op") != "d"), replaced('"total_amount":[^,]+', '"total_amount":1000000000')),
        (every(29), replaced('"ts_ms":[0-9]+', '"ts_ms":999999999999999999')),
        (every(31), replaced('"sale_id":[0-9]+', '"sale_id":null')),
        (every(37), replaced('"op":"[a-z]"', '"op":"x"')),
    ]
    copies = F.array(
        F.struct(F.col("record_content"), F.col("_kafka_offset"), F.col("_kafka_timestamp")),
        # the broker delivers the same record twice
        F.when(F.col("event_id") % 10 == 0, F.struct("record_content", "_kafka_offset", "_kafka_timestamp")),
        # the connector replays an old change much later
        F.when(
            F.col("event_id") % 9 == 0,
            F.struct(
                F.col("record_content"),
                (F.col("_kafka_offset") + LATE_OFFSET).alias("_kafka_offset"),
                (F.col("_kafka_timestamp") + F.expr("interval 2 days")).alias("_kafka_timestamp"),
            ),
        ),
        # a delete is followed by an empty record
        F.when(
            F.col("op") == "d",
            F.struct(
                F.lit(None).cast("string").alias("record_content"),
                (F.col("_kafka_offset") + 2 * LATE_OFFSET).alias("_kafka_offset"),
                F.col("_kafka_timestamp"),
            ),
        ),
        # records that no parser accepts
        *[
            F.when(
                affected,
                F.struct(
                    content.alias("record_content"),
                    (F.col("_kafka_offset") + place * LATE_OFFSET).alias("_kafka_offset"),
                    F.col("_kafka_timestamp"),
                ),
            )
            for place, (affected, content) in enumerate(rejected, start=3)
        ],
    )
    kept = F.filter(copies, lambda record: record.isNotNull())
    rest = ["event_id", "ts", "op", "_kafka_topic", "_kafka_partition"]
    return log.select(*rest, F.inline(kept))
