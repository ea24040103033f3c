"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Break remaining ties by content, so the surviving row never depends on how
# rows were distributed. Rows equal in all of these are interchangeable.
CONTENT_ORDER = [
    "product_id",
    "store_id",
    "total_amount",
    "quantity",
    "discount_amount",
    "tax_amount",
    "_cdc_operation",
]


def content_order(df: DataFrame, columns: Sequence[str] = CONTENT_ORDER) -> list[Column]:
    """Ascending order over those of ``columns`` that the frame has."""
    return [F.asc_nulls_last(name) for name in columns if name in df.columns]


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``.

    The ``rn = 1`` filter sits directly on the window, so Spark first keeps one
    row per key inside every map task (a group limit before the shuffle): a key
    that holds a large share of all rows reaches its reducer as at most one row
    per map task.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def latest_live_row(live: DataFrame) -> DataFrame:
    """Newest live row per sale, by change time and then by source commit time."""
    order = [F.desc_nulls_last("updated_at")]
    if "_cdc_source_ts" in live.columns:
        order.append(F.desc_nulls_last("_cdc_source_ts"))
    return latest_by_key(live, ["sale_id"], [*order, *content_order(live)])


def latest_event_per_key(events: DataFrame) -> DataFrame:
    """Newest change event per sale: source commit time, then log offset.

    A delete wins over a live event with the same position.
    """
    order = [
        F.desc_nulls_last("_cdc_source_ts"),
        F.desc_nulls_last("_kafka_offset"),
        F.desc_nulls_last("is_deleted"),
    ]
    return latest_by_key(events, ["sale_id"], [*order, *content_order(events)])


def latest_change_per_key(changes: DataFrame) -> DataFrame:
    """Newest batch change per sale over live rows and markers together.

    A batch may hold both for one key; a merge needs exactly one, so the later
    change wins and a delete wins a tie.
    """
    order = [F.desc_nulls_last("updated_at"), F.desc_nulls_last("is_deleted")]
    return latest_by_key(changes, ["sale_id"], [*order, *content_order(changes)])
