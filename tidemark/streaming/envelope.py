"""Parse change-event envelopes into staged rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import from_epoch_millis, region_label, wire_timestamp
from tidemark.operators.enrich import derive_date_parts
from tidemark.schemas import COMPLETED, STAGE_COLUMNS, conform

# Only these fields are parsed out of a record; others are skipped. Money
# arrives as double, timestamps as epoch milliseconds or text.
_IMAGE = (
    "struct<sale_id: bigint, customer_id: string, product_id: string, sale_date: string, quantity: int, "
    "unit_price: double, total_amount: double, store_id: string, payment_method: string, "
    "discount_amount: double, tax_amount: double, created_at: string, updated_at: string, "
    "is_deleted: boolean, status: string, region: string>"
)
ENVELOPE = f"after {_IMAGE}, before {_IMAGE}, op string, ts_ms bigint, region string, _corrupt string"
MONEY = "decimal(10,2)"
MONEY_FIELDS = ("unit_price", "total_amount", "discount_amount", "tax_amount")
METADATA = ["_kafka_topic", "_kafka_partition", "_kafka_offset", "_kafka_timestamp"]


def open_envelopes(raw: DataFrame, content: str = "record_content") -> DataFrame:
    """Drop empty records (tombstones) and parse the others once, into ``e``.

    Exploding the one-element array holds the parsed record as a column of its
    own; as a plain expression it would be parsed again for every condition
    and field that refers to it.
    """
    parsed = F.from_json(F.col(content), ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return raw.filter(F.col(content).isNotNull()).select("*", F.explode(F.array(parsed)).alias("e"))


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def _bad_amount() -> Column:
    """An amount that was sent, or one derived from it, does not fit its column."""
    sent = [F.col(f"e.after.{name}").isNotNull() & _money(name).isNull() for name in MONEY_FIELDS]
    return _any([*sent, *[value.isNull() for value in _derived_amounts()]])


def _bad_timestamp() -> Column:
    """A time that was sent cannot be read, or lies outside the calendar."""
    texts = [F.col("e.after.sale_date"), F.col("e.after.created_at"), after_or_before("updated_at")]
    sent = [text.isNotNull() & wire_timestamp(text).isNull() for text in texts]
    return _any([*sent, F.col("e.ts_ms").isNotNull() & from_epoch_millis(F.col("e.ts_ms")).isNull()])


def rejection_reason() -> Column:
    """Why a record cannot be used, NULL if it can."""
    key = F.coalesce(F.col("e.after.sale_id"), F.col("e.before.sale_id"))
    return (
        F.when(F.col("e._corrupt").isNotNull(), "unreadable")
        .when(key.isNull(), "no_key")
        .when(F.col("e.op").isNull() | ~F.col("e.op").isin("c", "u", "d", "r"), "unknown_operation")
        .when(_bad_amount(), "bad_amount")
        .when(_bad_timestamp(), "bad_timestamp")
    )


def dead_letters(raw: DataFrame) -> DataFrame:
    """Records that cannot be used, whole, with reason and log position."""
    opened = open_envelopes(raw).withColumn("rejection_reason", rejection_reason())
    return opened.filter(F.col("rejection_reason").isNotNull()).drop("e")


def usable(opened: DataFrame) -> DataFrame:
    """Opened records that can be parsed."""
    return opened.filter(rejection_reason().isNull())


def completed_or_deleted(opened: DataFrame) -> DataFrame:
    """Changes of completed sales, and all deletes."""
    done = F.coalesce(F.col("e.after.status") == COMPLETED, F.lit(True))
    return opened.filter(done | (F.col("e.op") == "d"))


def after_or_before(field: str) -> Column:
    """A field of the new image, or of the old one where the new lacks it."""
    return F.coalesce(F.col(f"e.after.{field}"), F.col(f"e.before.{field}"))


def delete_flag() -> Column:
    """Deleted by operation or by the row's own flag; never NULL."""
    return F.coalesce((F.col("e.op") == "d") | F.col("e.after.is_deleted"), F.lit(False))


def region_code() -> Column:
    """Region of the row, else the one stamped on the envelope."""
    return F.coalesce(after_or_before("region"), F.col("e.region"))


def _money(field: str) -> Column:
    return F.col(f"e.after.{field}").try_cast(MONEY)


def _money_or_zero(field: str) -> Column:
    return F.coalesce(_money(field), F.lit(0).cast(MONEY))


def _derived_amounts() -> tuple[Column, Column]:
    """Net amount and gross profit, NULL where they do not fit."""
    net = _money_or_zero("total_amount") - _money_or_zero("discount_amount")
    return net.try_cast(MONEY), (net - _money_or_zero("tax_amount")).try_cast(MONEY)


def parse_envelopes(
    raw: DataFrame, as_of: dt.datetime, completed_only: bool = True, labels: dict[str, str] | None = None
) -> DataFrame:
    """Raw records as staged rows, deletes included.

    Casts apply to the new image only, so a delete, which has none, passes as
    a marker with NULLs. Unusable records are left to ``dead_letters``.
    """
    opened = usable(open_envelopes(raw))
    if completed_only:
        opened = completed_or_deleted(opened)
    net_amount, gross_profit = _derived_amounts()
    fields = opened.select(
        after_or_before("sale_id").alias("sale_id"),
        *[F.col(f"e.after.{name}") for name in ("customer_id", "product_id", "store_id", "payment_method", "quantity")],
        _money("unit_price").alias("unit_price"),
        _money("total_amount").alias("total_amount"),
        _money_or_zero("discount_amount").alias("discount_amount"),
        _money_or_zero("tax_amount").alias("tax_amount"),
        net_amount.alias("net_amount"),
        gross_profit.alias("gross_profit"),
        region_label(region_code(), labels).alias("region"),
        wire_timestamp(F.col("e.after.sale_date")).alias("sale_date"),
        wire_timestamp(F.col("e.after.created_at")).alias("created_at"),
        wire_timestamp(after_or_before("updated_at")).alias("updated_at"),
        delete_flag().alias("is_deleted"),
        F.col("e.op").alias("_cdc_operation"),
        from_epoch_millis(F.col("e.ts_ms")).alias("_cdc_source_ts"),
        "_kafka_offset",
    )
    now = F.lit(as_of).cast("timestamp_ntz")
    derived = derive_date_parts(fields).withColumns(
        {
            "etl_loaded_at": now,
            "etl_batch_id": F.date_format(now, "yyyyMMdd"),
        }
    )
    return conform(derived, STAGE_COLUMNS)


def route_topic(raw: DataFrame, pattern: str, topic: str) -> DataFrame:
    """Rename topics that match a pattern."""
    return raw.withColumn("_kafka_topic", F.regexp_replace("_kafka_topic", pattern, topic))


def stamp_region(raw: DataFrame, region: str, content: str = "record_content") -> DataFrame:
    """Put a capture's region on each of its JSON envelopes."""
    opened = F.regexp_replace(F.col(content), r"^\s*\{", f'{{"region":"{region}",')
    return raw.withColumn(content, opened)
