"""Registered queries: streaming jobs run to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators.merge import live_rows
from tidemark.plans import inputs
from tidemark.plans.oracle import CONTENT, EVENTS_AS_OF, REJECTED, REJECTED_COUNT, REJECTED_NEWEST, REJECTED_ROWS, sql
from tidemark.plans.registry import query
from tidemark.schemas import FACT_COLUMNS, STAGE_COLUMNS, schema_of
from tidemark.session import fresh_path
from tidemark.sinks import fact_table
from tidemark.sources.change_events import LATE_OFFSET, change_log
from tidemark.streaming import envelope, monitor, pipeline, windows

_FACT_LIST = ", ".join(c for c in FACT_COLUMNS if not c.startswith("_row"))
# Records that come long after the log they belong to, by their offset.
_LATER = f"_kafka_offset >= {LATE_OFFSET}"
# What one micro-batch takes at most.
BATCH_BYTES = 256 * 1024**2


def _landed(spark: SparkSession, sf: str) -> str:
    path = fresh_path(spark, "landing")
    pipeline.land(inputs.raw_events(spark, sf), path, inputs.EVENTS_AS_OF)
    return path


def _staged(spark: SparkSession, sf: str) -> str:
    landing, path = _landed(spark, sf), fresh_path(spark, "staged")
    raw = pipeline.landed_stream(spark, landing, max_bytes=BATCH_BYTES)
    pipeline.parse_stream(raw, path, fresh_path(spark, "checkpoint"), inputs.EVENTS_AS_OF).awaitTermination()
    return path


def _merged(spark: SparkSession, sf: str) -> tuple[str, str]:
    staged, fact, audit = _staged(spark, sf), fresh_path(spark, "fact"), fresh_path(spark, "audit")
    pipeline.merge_stream(
        spark,
        staged,
        fact,
        audit,
        fresh_path(spark, "checkpoint"),
        inputs.EVENTS_AS_OF,
        max_bytes=BATCH_BYTES,
    ).awaitTermination()
    return fact, audit


@query(sql("parsed", "SELECT * FROM parsed"))
def stream_parse(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(schema_of(STAGE_COLUMNS)).parquet(_staged(spark, sf))


@query(sql("parsed", "SELECT * FROM parsed"))
def stream_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A finished stream started again on its checkpoint takes nothing twice."""
    landing, path, checkpoint = _landed(spark, sf), fresh_path(spark, "staged"), fresh_path(spark, "checkpoint")
    for _ in range(2):
        raw = pipeline.landed_stream(spark, landing, max_bytes=BATCH_BYTES)
        pipeline.parse_stream(raw, path, checkpoint, inputs.EVENTS_AS_OF).awaitTermination()
    return spark.read.schema(schema_of(STAGE_COLUMNS)).parquet(path)


@query(sql("delivered", "SELECT 'ASIA-PACIFIC' AS region, count(*) AS event_count FROM delivered"))
def region_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one regional capture, stamped with its region, read back by it."""
    unstamped = inputs.raw_events(spark, sf).withColumn("record_content", F.regexp_replace("record_content", ',"region":"[^"]*"', ""))
    stamped = envelope.stamp_region(unstamped, "asia_pacific")
    opened = envelope.usable(envelope.open_envelopes(stamped))
    return opened.groupBy(fn.region_label(envelope.region_code()).alias("region")).agg(F.count(F.lit(1)).alias("event_count"))


@query(
    sql(
        "latest_event",
        f"SELECT {_FACT_LIST}, {EVENTS_AS_OF} AS _row_inserted_at, {EVENTS_AS_OF} AS _row_updated_at "
        "FROM latest_event WHERE NOT is_deleted",
    )
)
def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    fact, _ = _merged(spark, sf)
    return live_rows(fact_table.read_fact(spark, fact, fact_table.TOMBSTONE_FACT_COLUMNS)).select(*FACT_COLUMNS)


_LATEST_OF = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sale_id
  ORDER BY _cdc_source_ts DESC NULLS LAST, _kafka_offset DESC NULLS LAST, is_deleted DESC NULLS LAST, {CONTENT}) AS rn
  FROM parsed WHERE {{part}}) r WHERE rn = 1"""
_AUDIT = f"""SELECT 0 AS merge_id, (SELECT count(*) FROM f WHERE NOT is_deleted) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted,
  count(*) AS events, min(_kafka_offset) AS min_kafka_offset, max(_kafka_offset) AS max_kafka_offset FROM parsed WHERE NOT {_LATER}
UNION ALL
SELECT 1, (SELECT count(*) FROM acting WHERE NOT is_deleted AND NOT was_live), (SELECT count(*) FROM acting WHERE NOT is_deleted AND was_live),
  (SELECT count(*) FROM acting WHERE is_deleted AND was_live), count(*), min(_kafka_offset), max(_kafka_offset) FROM parsed WHERE {_LATER}"""


@query(
    sql("parsed", _AUDIT).replace(
        "\nSELECT 0 AS merge_id",
        f""",
f AS ({_LATEST_OF.format(part=f"NOT {_LATER}")}),
s AS ({_LATEST_OF.format(part=_LATER)}),
acting AS (SELECT s.is_deleted, f.sale_id IS NOT NULL AND NOT f.is_deleted AS was_live FROM s LEFT JOIN f ON s.sale_id = f.sale_id
  WHERE f.sale_id IS NULL OR s._cdc_source_ts > f._cdc_source_ts OR (s._cdc_source_ts = f._cdc_source_ts AND s._kafka_offset > f._kafka_offset))
SELECT 0 AS merge_id""",
        1,
    )
)
def stream_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The audit row of every micro-batch: the log's, then that of what comes after it."""
    records, names = inputs.raw_events(spark, sf), ("landing", "staged", "fact", "audit", "parsing", "merging")
    landing, staged, fact, path, parsing, merging = (fresh_path(spark, name) for name in names)
    for part in (f"NOT {_LATER}", _LATER):
        pipeline.land(records.filter(part), landing, inputs.EVENTS_AS_OF)
        pipeline.parse_stream(pipeline.landed_stream(spark, landing), staged, parsing, inputs.EVENTS_AS_OF).awaitTermination()
        pipeline.merge_stream(spark, staged, fact, path, merging, inputs.EVENTS_AS_OF).awaitTermination()
    counts = ["rows_inserted", "rows_updated", "rows_deleted", *pipeline.RANGE]
    return spark.read.parquet(path).select(F.col("merge_id").cast("int").alias("merge_id"), *[F.col(c).cast("bigint").alias(c) for c in counts])


@query(
    sql(
        "log",
        f"SELECT rejection_reason, count(*) AS record_count FROM ({REJECTED_ROWS}) r GROUP BY rejection_reason",
    )
)
def stream_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    landing, path = _landed(spark, sf), fresh_path(spark, "dead-letters")
    raw = pipeline.landed_stream(spark, landing)
    pipeline.dead_letter_stream(raw, path, fresh_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("record_count"))


_LATE_RECORDS = " UNION ALL ".join(
    [
        "SELECT ts + INTERVAL 2 DAY AS came FROM log WHERE event_id % 9 = 0",
        "SELECT ts FROM log WHERE op = 'd'",
        *[f"SELECT ts FROM log WHERE {affected}" for affected, _, _ in REJECTED],
    ]
)


@query(
    sql(
        "log",
        f"""SELECT 'kept' AS outcome, (SELECT count(*) FROM log) + count(*) FILTER (WHERE came > mark) AS record_count FROM late, bound
UNION ALL SELECT 'late', count(*) FILTER (WHERE came <= mark) FROM late, bound""",
    ).replace(
        "\nSELECT 'kept'",
        f""",
late AS ({_LATE_RECORDS}),
bound AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY AS mark FROM log)
SELECT 'kept'""",
        1,
    )
)
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The log first, then what comes after it: how much a bounded state lets through, and how much was too late for it."""
    records, landing, path, checkpoint = inputs.raw_events(spark, sf), *(fresh_path(spark, n) for n in ("landing", "distinct", "checkpoint"))
    late, delay = 0, monitor.redelivery_delay(records)
    for part in (f"NOT {_LATER}", _LATER):
        pipeline.land(records.filter(part), landing, inputs.EVENTS_AS_OF)
        distinct = pipeline.without_redelivered(pipeline.landed_stream(spark, landing), delay)
        writer = distinct.select("_kafka_partition", "_kafka_offset").writeStream.format("parquet").option("path", path)
        running = pipeline.start(writer, checkpoint)
        running.awaitTermination()
        late += monitor.late_rows(running)
    kept = spark.read.schema("_kafka_partition int, _kafka_offset bigint").parquet(path)
    counted = kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("record_count"))
    return counted.unionByName(spark.createDataFrame([("late", late)], "outcome string, record_count bigint"))


@query(
    sql(
        "parsed",
        f"""SELECT CAST(sale_date AS DATE) AS sale_date, region, count(*) AS event_count,
  CAST(sum(total_amount) AS DECIMAL(18,2)) AS revenue
FROM parsed, (SELECT max(CAST(sale_date AS DATE)) AS newest FROM parsed WHERE NOT is_deleted AND NOT {_LATER}) n
WHERE NOT is_deleted AND (NOT {_LATER} OR CAST(sale_date AS DATE) + 1 > newest - 1) GROUP BY 1, 2""",
    )
)
def stream_daily_window(spark: SparkSession, sf: str) -> DataFrame:
    """Daily windows of the log, and of what comes after it as far as the windows are still open."""
    records, names = inputs.raw_events(spark, sf), ("landing", "staged", "windows", "parsing", "counting")
    landing, staged, path, parsing, counting = (fresh_path(spark, name) for name in names)
    for part in (f"NOT {_LATER}", _LATER):
        pipeline.land(records.filter(part), landing, inputs.EVENTS_AS_OF)
        pipeline.parse_stream(pipeline.landed_stream(spark, landing), staged, parsing, inputs.EVENTS_AS_OF).awaitTermination()
        delay = windows.sale_delay(spark.read.schema(schema_of(STAGE_COLUMNS)).parquet(staged).filter(f"NOT {_LATER}"))
        rows = pipeline.landed_stream(spark, staged, schema_of(STAGE_COLUMNS))
        windows.daily_window_stream(rows, path, counting, delay).awaitTermination()
    schema = "event_count bigint, revenue decimal(18,2), sale_date date, region string"
    return spark.read.schema(schema).parquet(path)


@query(
    sql(
        "log",
        f"""SELECT CAST(event_id % 4 AS INTEGER) AS _kafka_partition,
  greatest(max(event_id), max(event_id + 1000000000000) FILTER (WHERE event_id % 9 = 0),
    max(event_id + 2000000000000) FILTER (WHERE op = 'd'), {REJECTED_NEWEST}) AS landed_offset,
  max(event_id) AS merged_offset,
  count(*) FILTER (WHERE event_id % 9 = 0) + count(*) FILTER (WHERE op = 'd') + {REJECTED_COUNT} AS pending, true AS has_data FROM log GROUP BY 1""",
    )
)
def stream_lag(spark: SparkSession, sf: str) -> DataFrame:
    landed = inputs.raw_events(spark, sf).select("_kafka_partition", "_kafka_offset")
    merged = change_log(spark, sf, noise=False).select("_kafka_partition", "_kafka_offset")
    return monitor.stream_lag(landed, merged)


@query(
    sql(
        "log",
        f"""SELECT newest, datesub('second', newest, {EVENTS_AS_OF}) AS age_seconds FROM (
  SELECT greatest(max(ts), max(ts) FILTER (WHERE event_id % 9 = 0) + INTERVAL 2 DAY) AS newest FROM log) n""",
    )
)
def landing_freshness(spark: SparkSession, sf: str) -> DataFrame:
    landed = spark.read.schema(pipeline.RAW_DDL).parquet(_landed(spark, sf))
    return monitor.landing_age(landed, inputs.EVENTS_AS_OF)
