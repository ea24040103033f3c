"""Stream monitoring: pending data, lag, freshness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def progress(query: StreamingQuery) -> dict:
    """Newest batch of a query: id, rows, duration, and whether it had data."""
    last = query.lastProgress or {}
    return {
        "batch_id": last.get("batchId"),
        "input_rows": last.get("numInputRows", 0),
        "has_data": bool(last.get("numInputRows", 0)),
        "duration_ms": (last.get("durationMs") or {}).get("triggerExecution"),
    }


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators have dropped as too late, over the batches its progress still lists."""
    operators = [operator for batch in query.recentProgress for operator in batch["stateOperators"]]
    return sum(operator["numRowsDroppedByWatermark"] for operator in operators)


def redelivery_delay(landed: DataFrame, least: str = "1 day") -> str:
    """How far apart two deliveries of one log position have been, and ``least`` at least, as a watermark's delay."""
    spans = landed.groupBy("_kafka_partition", "_kafka_offset").agg(
        F.timestamp_diff("SECOND", F.min("_kafka_timestamp"), F.max("_kafka_timestamp")).alias("apart")
    )
    minimum = F.unix_seconds(F.lit("1970-01-01T00:00:00Z").cast("timestamp") + F.expr(f"interval {least}"))
    widest = spans.agg(F.greatest(F.coalesce(F.max("apart") + 1, F.lit(0)), minimum).alias("delay")).first().delay
    return f"{widest} seconds"


def stream_lag(landed: DataFrame, merged: DataFrame) -> DataFrame:
    """Per log partition: newest landed offset, newest merged offset, records behind.

    The merged offsets, one per log partition, reach the rows as a map, so the
    log is read once and counted before it is shuffled.
    """
    done = merged.filter(F.col("_kafka_partition").isNotNull()).groupBy("_kafka_partition").agg(F.max("_kafka_offset").alias("done"))
    offsets = done.agg(F.map_from_entries(F.collect_list(F.struct("_kafka_partition", "done"))).alias("offsets")).scalar()
    placed = landed.withColumn("merged_offset", F.try_element_at(offsets, F.col("_kafka_partition")))
    behind = F.coalesce(F.col("_kafka_offset") > F.col("merged_offset"), F.lit(True))
    return placed.groupBy("_kafka_partition").agg(
        F.max("_kafka_offset").alias("landed_offset"),
        F.max("merged_offset").alias("merged_offset"),
        F.count_if(behind).alias("pending"),
        (F.count_if(behind) > 0).alias("has_data"),
    )


def landing_age(landed: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Seconds since the newest landed record arrived."""
    newest = landed.agg(F.max("_kafka_timestamp").alias("newest"))
    now = F.lit(as_of).cast("timestamp_ntz")
    return newest.withColumn("age_seconds", F.timestamp_diff("SECOND", F.col("newest"), now))
