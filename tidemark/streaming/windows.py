"""Streaming daily aggregate over insert-only sales events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.partitions import replace_slices
from tidemark.streaming.pipeline import keep_state_on_disk, start


def daily_windows(staged: DataFrame, lateness: str) -> DataFrame:
    """Orders and revenue per day and region behind a watermark on the sale time.

    Counts events as they come; it cannot take back an updated or deleted
    sale, so the merged fact stays the authority.
    """
    timed = staged.filter(~F.col("is_deleted")).withColumn("_sold_at", F.col("sale_date").cast("timestamp"))
    return (
        timed.withWatermark("_sold_at", lateness)
        .groupBy(F.window("_sold_at", "1 day").alias("w"), "region")
        .agg(F.count(F.lit(1)).alias("event_count"), F.sum("total_amount").cast("decimal(18,2)").alias("revenue"))
        .select(F.to_date("w.start").alias("sale_date"), "region", "event_count", "revenue")
    )


def sale_delay(staged: DataFrame, least_seconds: int = 86_400) -> str:
    """How long after a sale's time its changes have been committed, and ``least_seconds`` at least, as a watermark's delay."""
    behind = F.timestamp_diff("SECOND", F.col("sale_date"), F.col("_cdc_source_ts"))
    widest = staged.agg(F.greatest(F.coalesce(F.max(behind) + 1, F.lit(0)), F.lit(least_seconds)).alias("delay")).first().delay
    return f"{widest} seconds"


def daily_window_stream(staged: DataFrame, path: str, checkpoint: str, lateness: str, every: str | None = None) -> StreamingQuery:
    """Keep a table of daily windows current; their state lies in RocksDB and ends with the watermark.

    Each micro-batch emits only the groups it changed and replaces exactly
    those, so running it again changes nothing.
    """

    def write_changed(batch: DataFrame, _: int) -> None:
        replace_slices(batch, path, ["sale_date", "region"])

    keep_state_on_disk(staged.sparkSession)
    writer = daily_windows(staged, lateness).writeStream.outputMode("update").foreachBatch(write_changed)
    return start(writer, checkpoint, every)
