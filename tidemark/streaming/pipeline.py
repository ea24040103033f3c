"""Streaming jobs: land, parse, merge, audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.operators.dedup import latest_event_per_key
from tidemark.schemas import STAGE_COLUMNS, schema_of
from tidemark.sinks.fact_table import is_merged, merge_into_fact
from tidemark.sinks.partitions import replace_slices
from tidemark.streaming.envelope import dead_letters, parse_envelopes

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RAW_DDL = (
    "record_content string, _kafka_topic string, _kafka_partition int, _kafka_offset bigint, "
    "_kafka_timestamp timestamp_ntz, _inserted_at timestamp_ntz"
)


def land(raw: DataFrame, path: str, inserted_at: dt.datetime) -> None:
    """Append raw records to the landing table, one folder per log partition."""
    stamped = raw.withColumn("_inserted_at", F.lit(inserted_at).cast("timestamp_ntz"))
    stamped.write.mode("append").partitionBy("_kafka_partition").parquet(path)


def land_stream(records: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Land a record stream continuously; arrival time is the processing time."""
    stamped = records.withColumn("_inserted_at", F.current_timestamp().cast("timestamp_ntz"))
    return start(stamped.writeStream.format("parquet").partitionBy("_kafka_partition").option("path", path), checkpoint, **trigger)


def kafka_records(spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Records of a topic from the earliest on, in landing-table columns.

    Needs the Kafka connector on the classpath. The initial snapshot of a
    source is simply the first records of its topic.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    records = reader.option("startingOffsets", "earliest").options(**dict(options or {})).load()
    return records.select(
        F.col("value").cast("string").alias("record_content"),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.col("timestamp").cast("timestamp_ntz").alias("_kafka_timestamp"),
    )


def landed_stream(spark: SparkSession, path: str, ddl: str = RAW_DDL, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """New rows of a landing or staged table.

    ``max_files`` or ``max_bytes`` bound what one micro-batch takes.
    """
    reader = spark.readStream.schema(ddl)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a query: every ``every`` (for example ``"60 seconds"``), or once over what is there now."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def parse_stream(raw: DataFrame, staged_path: str, checkpoint: str, as_of: dt.datetime, every: str | None = None) -> StreamingQuery:
    """Parse landed records and append them to the staged table."""
    staged = parse_envelopes(raw, as_of)
    return start(staged.writeStream.format("parquet").option("path", staged_path), checkpoint, every)


def dead_letter_stream(raw: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Divert unusable records, whole, by reason."""
    writer = dead_letters(raw).writeStream.format("parquet").partitionBy("rejection_reason").option("path", path)
    return start(writer, checkpoint, every)


def keep_state_on_disk(spark: SparkSession) -> None:
    """Let stateful streams of the session keep their state in RocksDB, outside the executors' heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def without_redelivered(records: DataFrame, within: str) -> DataFrame:
    """Drop records delivered again, by log position, within ``within`` of arrival time.

    State is bounded by that time (``monitor.redelivery_delay`` takes it from
    the log) and lies in RocksDB. A record that arrives later than it behind
    the newest one is dropped too; ``monitor.late_rows`` counts these.
    """
    keep_state_on_disk(records.sparkSession)
    watermarked = records.withColumn("_arrived", F.col("_kafka_timestamp").cast("timestamp")).withWatermark("_arrived", within)
    return watermarked.dropDuplicatesWithinWatermark(["_kafka_partition", "_kafka_offset"]).drop("_arrived")


def merge_stream(
    spark: SparkSession,
    staged_path: str,
    fact_path: str,
    audit_path: str,
    checkpoint: str,
    as_of: dt.datetime,
    max_files: int | None = None,
    every: str | None = None,
    max_bytes: int | None = None,
) -> StreamingQuery:
    """Merge newly staged rows into the fact table, newest change per sale.

    A micro-batch may run again after a failure. Its merge is named by query
    and batch and compares log positions, and its audit row overwrites itself,
    so running it twice has the effect of running it once. A renewed checkpoint
    is a new query: its merges and audit rows are its own.
    """
    ddl = schema_of(STAGE_COLUMNS)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_id = f"{query_id}-{batch_id}"
        # The merge reads the batch once, and counts it on the way; only a merge that was done before does not.
        seen = None if is_merged(session, fact_path, run_id) else Observation()
        latest = latest_event_per_key(batch if seen is None else batch.observe(seen, *_offset_range()))
        tally = merge_into_fact(session, fact_path, latest, as_of, run_id, newest_only=True, once=True)
        ranged = offset_range(batch) if seen is None else session.createDataFrame([tuple(seen.get[n] for n in RANGE)], RANGE_DDL)
        audit = audit_row(ranged, tally, batch_id, as_of).withColumn("query_id", F.lit(query_id))
        replace_slices(audit, audit_path, ["query_id", "merge_id"])

    stream = landed_stream(spark, staged_path, ddl, max_files=max_files, max_bytes=max_bytes)
    return start(stream.writeStream.foreachBatch(merge_batch), checkpoint, every)


RANGE = ["events", "min_kafka_offset", "max_kafka_offset"]
RANGE_DDL = ", ".join(f"{name} bigint" for name in RANGE)


def _offset_range() -> list[Column]:
    offset = F.col("_kafka_offset")
    return [c.alias(name) for c, name in zip((F.count(F.lit(1)), F.min(offset), F.max(offset)), RANGE, strict=True)]


def offset_range(batch: DataFrame) -> DataFrame:
    """Number of events of a batch and the log positions they span."""
    return batch.agg(*_offset_range())


def audit_row(ranged: DataFrame, tally: DataFrame, batch_id: int, as_of: dt.datetime) -> DataFrame:
    """One row about one merge: counts, offset range (a row of ``offset_range``), status."""
    done = {name: tally.select(name).scalar() for name in tally.columns}
    return ranged.select(
        F.lit(batch_id).cast("bigint").alias("merge_id"),
        F.lit(as_of).cast("timestamp_ntz").alias("merge_timestamp"),
        *[count.alias(name) for name, count in done.items()],
        "events",
        "min_kafka_offset",
        "max_kafka_offset",
        F.lit("sales_staged").alias("stream_name"),
        F.lit("merge_to_fact").alias("task_name"),
        F.lit("SUCCESS").alias("status"),
    )
