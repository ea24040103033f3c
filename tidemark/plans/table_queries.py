"""Registered queries: merge, incremental models, history, stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.operators import aggregates, enrich, incremental, merge, snapshot, staging
from tidemark.operators.enrich import quarantined
from tidemark.plans import inputs
from tidemark.plans.oracle import AS_OF, DATA_LIST, UPDATED_LIST, daily, money, sql
from tidemark.plans.registry import query
from tidemark.schemas import FACT_COLUMNS, schema_of
from tidemark.session import fresh_path, written
from tidemark.sinks import contract as contracts
from tidemark.sinks import csv_export, evolving, fact_table, partitions
from tidemark.sources import extract, files

_FACT_LIST = ", ".join(FACT_COLUMNS)


# --- merge ----------------------------------------------------------------------
@query(sql("merged", "SELECT * FROM merged"))
def cdc_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge.cdc_merge(inputs.old_fact(spark, sf), inputs.changes(spark, sf), inputs.AS_OF)


@query(sql("actions", "SELECT * FROM actions"))
def cdc_merge_actions(spark: SparkSession, sf: str) -> DataFrame:
    actions = merge.merge_changes(inputs.old_fact(spark, sf), inputs.changes(spark, sf), inputs.AS_OF)
    return actions.select("sale_id", merge.ACTION)


@query(
    sql(
        "actions",
        """SELECT count(*) FILTER (WHERE _merge_action = 'insert') AS rows_inserted,
  count(*) FILTER (WHERE _merge_action = 'update') AS rows_updated,
  count(*) FILTER (WHERE _merge_action = 'delete') AS rows_deleted FROM actions""",
    )
)
def cdc_merge_tally(spark: SparkSession, sf: str) -> DataFrame:
    actions = merge.merge_changes(inputs.old_fact(spark, sf), inputs.changes(spark, sf), inputs.AS_OF)
    return merge.merge_tally(actions)


@query(sql("merged", "SELECT * FROM merged"))
def merge_stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "fact")
    fact_table.write_fact(inputs.old_fact(spark, sf), path)
    fact_table.merge_into_fact(spark, path, inputs.changes(spark, sf), inputs.AS_OF, "run-1")
    return fact_table.read_fact(spark, path)


@query(sql("merged", "SELECT * FROM merged"))
def replayed_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A first load with wrong amounts, a later batch, the first load again with the right ones, the later batch again."""
    path = fresh_path(spark, "fact")
    first, later = written(inputs.old_fact(spark, sf), "first"), written(inputs.changes(spark, sf), "later")
    wrong = first.withColumn("quantity", F.col("quantity") + 1)
    fact_table.merge_into_fact(spark, path, wrong, inputs.CUT, "batch-1")
    fact_table.merge_into_fact(spark, path, later, inputs.AS_OF, "batch-2")
    fact_table.merge_into_fact(spark, path, first, inputs.CUT, "batch-1")
    fact_table.merge_into_fact(spark, path, later, inputs.AS_OF, "batch-2")
    return fact_table.read_fact(spark, path)


@query(sql("merged", "SELECT * FROM merged", completed_only=True))
def merge_bucketed_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Merge into a table that is partitioned by month and key bucket."""
    path = fresh_path(spark, "fact")
    fact_table.write_fact(inputs.old_fact(spark, sf, completed_only=True), path, buckets=4)
    fact_table.merge_into_fact(spark, path, inputs.changes(spark, sf, completed_only=True), inputs.AS_OF, "run-1")
    return fact_table.read_fact(spark, path)


_CORRECTED = """corrected AS (
  SELECT * REPLACE (CASE WHEN payment_method = 'cash' AND quantity >= 40 THEN sale_date + INTERVAL 1 DAY ELSE sale_date END AS sale_date,
    CASE WHEN payment_method = 'cash' AND quantity >= 40 THEN 'EUROPE' ELSE region END AS region)
  FROM merged WHERE NOT (payment_method = 'credit' AND quantity <= 2))"""


def _corrections(fact: DataFrame) -> DataFrame:
    """Large cash sales turn out to be of the next day and of Europe, the smallest credit sales are cancelled."""
    moved = (F.col("payment_method") == "cash") & (F.col("quantity") >= 40)
    gone = (F.col("payment_method") == "credit") & (F.col("quantity") <= 2)
    day = F.when(moved, F.col("sale_date") + F.make_dt_interval(F.lit(1))).otherwise(F.col("sale_date"))
    rows = fact.filter(F.coalesce(moved | gone, F.lit(False))).withColumns(
        {"is_deleted": gone, "sale_date": day, "region": F.when(moved, "EUROPE").otherwise(F.col("region"))}
    )
    return enrich.derive_date_parts(rows)


def _merged_three_times(spark: SparkSession, sf: str, **options) -> str:
    """The first load, the later changes and corrections, each merged; where the table lies."""
    path = fresh_path(spark, "fact")
    fact_table.merge_into_fact(spark, path, inputs.old_fact(spark, sf, completed_only=True), inputs.CUT, "batch-1", **options)
    fact_table.merge_into_fact(spark, path, inputs.changes(spark, sf, completed_only=True), inputs.AS_OF, "batch-2", **options)
    corrections = written(_corrections(fact_table.read_fact(spark, path)), "corrections")
    fact_table.merge_into_fact(spark, path, corrections, inputs.AS_OF, "batch-3", **options)
    return path


@query(
    sql("merged", "SELECT 1", completed_only=True).removesuffix("\nSELECT 1")
    + f",\n{_CORRECTED}\nSELECT * EXCLUDE (_aggregated_at) FROM ({daily('corrected')}) d"
)
def stored_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily KPIs kept beside the fact through three merges, with sales that move and sales that go."""
    path = _merged_three_times(spark, sf, daily=True)
    return fact_table.read_daily(spark, path).drop("_aggregated_at")


_UPSERTED = f"""SELECT coalesce(o.sale_id, n.sale_id) AS sale_id, coalesce(o.created_at, n.created_at) AS created_at,
  {', '.join(f'CASE WHEN n.sale_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}' for c in UPDATED_LIST)},
  coalesce(o._row_inserted_at, {AS_OF}) AS _row_inserted_at,
  CASE WHEN n.sale_id IS NULL THEN o._row_updated_at ELSE {AS_OF} END AS _row_updated_at
FROM old_fact o FULL OUTER JOIN {{delta}} n ON o.sale_id = n.sale_id"""


@query(sql("old_fact new_fact", _UPSERTED.format(delta="new_fact")))
def upsert_fact(spark: SparkSession, sf: str) -> DataFrame:
    delta = inputs.fact_of(inputs.after_cut(spark, sf), inputs.AS_OF)
    return merge.upsert(inputs.old_fact(spark, sf), delta, inputs.AS_OF)


@query(sql("fact", "SELECT * FROM fact WHERE sale_id NOT IN (SELECT sale_id FROM sales WHERE is_deleted)"))
def delete_by_markers(spark: SparkSession, sf: str) -> DataFrame:
    return merge.delete_by_markers(inputs.fact(spark, sf), staging.delete_markers(inputs.sales(spark, sf)))


_NEWER = "(SELECT * FROM fact WHERE etl_loaded_at > (SELECT coalesce(max(etl_loaded_at), TIMESTAMP '1900-01-01') FROM old_fact))"


@query(
    sql(
        "old_fact fact",
        f"SELECT * FROM ({_UPSERTED.format(delta=_NEWER)}) u WHERE sale_id NOT IN (SELECT sale_id FROM sales WHERE is_deleted)",
    )
)
def incremental_fact(spark: SparkSession, sf: str) -> DataFrame:
    markers = staging.delete_markers(inputs.sales(spark, sf))
    target = written(inputs.old_fact(spark, sf), "fact")
    return incremental.incremental_fact(target, inputs.validated(spark, sf), inputs.AS_OF, markers)


@query(
    sql(
        "old_fact fact",
        f"SELECT {DATA_LIST} FROM fact WHERE etl_loaded_at > (SELECT max(etl_loaded_at) - INTERVAL 3 DAY FROM old_fact)",
    )
)
def lookback_delta(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.fact(spark, sf).drop("_row_inserted_at", "_row_updated_at")
    return incremental.newer_than(rows, inputs.old_fact(spark, sf), lookback_days=3)


@query(
    sql(
        "old_daily merged",
        f"""SELECT * FROM ({daily('merged')}) d WHERE sale_date >= (SELECT max(sale_date) FROM old_daily)
UNION ALL SELECT * FROM old_daily o WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE CAST(m.sale_date AS DATE) = o.sale_date
  AND m.region = o.region AND o.sale_date >= (SELECT max(sale_date) FROM old_daily))""",
    )
)
def incremental_daily(spark: SparkSession, sf: str) -> DataFrame:
    old = written(inputs.old_fact(spark, sf), "fact")
    new = merge.cdc_merge(old, inputs.changes(spark, sf), inputs.AS_OF)
    return incremental.incremental_daily_high_water(aggregates.daily_sales(old, inputs.AS_OF), new, inputs.AS_OF)


@query(sql("merged", daily("merged")))
def incremental_daily_touched(spark: SparkSession, sf: str) -> DataFrame:
    old = written(inputs.old_fact(spark, sf), "fact")
    changes = written(inputs.changes(spark, sf), "changes")
    new = written(merge.cdc_merge(old, changes, inputs.AS_OF), "fact")
    return incremental.incremental_daily_touched(
        aggregates.daily_sales(old, inputs.AS_OF), old, new, changes, inputs.AS_OF
    )


@query(sql("fact", "SELECT * FROM fact WHERE etl_batch_id <> '199806'"))
def rollback_batch(spark: SparkSession, sf: str) -> DataFrame:
    return merge.rollback_batch(inputs.fact(spark, sf), "199806")


@query(
    sql(
        "old_fact new_fact",
        "SELECT * EXCLUDE (gross_profit) FROM old_fact UNION ALL BY NAME SELECT * FROM new_fact",
    )
)
def schema_append(spark: SparkSession, sf: str) -> DataFrame:
    target = inputs.old_fact(spark, sf).drop("gross_profit")
    return merge.append_rows(target, inputs.fact_of(inputs.after_cut(spark, sf), inputs.AS_OF))


def _two_generations(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    """A stored table without profit, then rows with it, without discounts, and with wider quantities."""
    path = fresh_path(spark, "evolving")
    evolving.append(inputs.old_fact(spark, sf, completed_only=True).drop("gross_profit"), path)
    later = inputs.fact_of(inputs.after_cut(spark, sf, completed_only=True), inputs.AS_OF).drop("discount_amount")
    try:
        evolving.append(later.withColumn("quantity", F.col("quantity").cast("bigint")), path, policy)
    except merge.SchemaChangeError:
        if policy != "fail":
            raise
    return evolving.read(spark, path)


def _generations(old: str, new: str) -> str:
    wide = "REPLACE (CAST(quantity AS BIGINT) AS quantity)"
    return sql(
        "old_fact new_fact",
        f"SELECT * EXCLUDE ({old}) {wide} FROM old_fact UNION ALL BY NAME SELECT * EXCLUDE ({new}) {wide} FROM new_fact",
        completed_only=True,
    )


@query(_generations("gross_profit", "gross_profit, discount_amount"))
def schema_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return _two_generations(spark, sf, "ignore")


@query(_generations("gross_profit", "discount_amount"))
def schema_append_stored(spark: SparkSession, sf: str) -> DataFrame:
    return _two_generations(spark, sf, "append_new_columns")


@query(_generations("gross_profit, discount_amount", "discount_amount"))
def schema_sync(spark: SparkSession, sf: str) -> DataFrame:
    return _two_generations(spark, sf, "sync_all_columns")


@query(sql("old_fact", "SELECT * EXCLUDE (gross_profit) FROM old_fact", completed_only=True))
def schema_fail(spark: SparkSession, sf: str) -> DataFrame:
    """Under this policy the second generation is refused and the table stays."""
    return _two_generations(spark, sf, "fail")


@query(
    sql(
        "old_fact new_fact",
        "SELECT * FROM old_fact WHERE sale_id NOT IN (SELECT sale_id FROM new_fact) UNION ALL SELECT * FROM new_fact",
    )
)
def delete_insert(spark: SparkSession, sf: str) -> DataFrame:
    delta = inputs.fact_of(inputs.after_cut(spark, sf), inputs.AS_OF)
    return merge.delete_insert(inputs.old_fact(spark, sf), delta, ["sale_id"])


# --- history ----------------------------------------------------------------------
def _version(alias: str, opens: str) -> str:
    return (
        f"{', '.join(f'{alias}.{c}' for c in FACT_COLUMNS)}, "
        f"md5({alias}.sale_id || '|' || strftime({opens}, '%Y-%m-%d %H:%M:%S.%f')) AS dbt_scd_id, {opens} AS dbt_valid_from"
    )


def _history(vanished: str) -> str:
    return f"""SELECT {_version('o', 'o.updated_at')}, CASE WHEN m.sale_id IS NULL THEN {vanished}
    WHEN m.updated_at > o.updated_at THEN m.updated_at END AS dbt_valid_to, o.updated_at AS dbt_updated_at
  FROM old_fact o LEFT JOIN merged m ON o.sale_id = m.sale_id
UNION ALL
  SELECT {_version('m', 'm.updated_at')}, NULL, m.updated_at
  FROM merged m LEFT JOIN old_fact o ON o.sale_id = m.sale_id
  WHERE o.sale_id IS NULL OR m.updated_at > o.updated_at"""


def _snapshots(spark: SparkSession, sf: str, **options) -> DataFrame:
    old = written(inputs.old_fact(spark, sf), "fact")
    new = merge.cdc_merge(old, inputs.changes(spark, sf), inputs.AS_OF)
    return snapshot.take_snapshot(snapshot.first_snapshot(old), new, inputs.AS_OF, **options)


@query(sql("merged", _history(AS_OF)))
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf)


@query(sql("merged", f"SELECT * FROM ({_history(AS_OF)}) h WHERE dbt_valid_to IS NULL"))
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.current_versions(_snapshots(spark, sf))


@query(
    sql(
        "merged",
        f"""SELECT * FROM ({_history(AS_OF)}) h WHERE dbt_valid_from <= TIMESTAMP '2000-12-01'
  AND (dbt_valid_to > TIMESTAMP '2000-12-01' OR dbt_valid_to IS NULL)""",
    )
)
def scd2_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.versions_at(_snapshots(spark, sf), dt.datetime(2000, 12, 1))


@query(sql("merged", _history("NULL")))
def scd2_hard_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf, invalidate_hard_deletes=False)


@query(sql("merged", _history(AS_OF), completed_only=True))
def stored_history(spark: SparkSession, sf: str) -> DataFrame:
    """The version history kept beside the fact: only changed keys are ever written."""
    path = fresh_path(spark, "fact")
    fact_table.write_fact(inputs.old_fact(spark, sf, completed_only=True), path)
    fact_table.merge_into_fact(spark, path, inputs.changes(spark, sf, completed_only=True), inputs.AS_OF, "run-1", history=True)
    return fact_table.read_history(spark, path)


_CHANGED = "(o.total_amount IS DISTINCT FROM m.total_amount OR o.store_id IS DISTINCT FROM m.store_id)"


@query(
    sql(
        "merged",
        f"""SELECT {_version('o', 'o.updated_at')}, CASE WHEN m.sale_id IS NULL OR {_CHANGED} THEN {AS_OF} END AS dbt_valid_to,
    o.updated_at AS dbt_updated_at FROM old_fact o LEFT JOIN merged m ON o.sale_id = m.sale_id
UNION ALL
  SELECT {_version('m', f'CASE WHEN o.sale_id IS NULL THEN m.updated_at ELSE {AS_OF} END')}, NULL,
    CASE WHEN o.sale_id IS NULL THEN m.updated_at ELSE {AS_OF} END
  FROM merged m LEFT JOIN old_fact o ON o.sale_id = m.sale_id WHERE o.sale_id IS NULL OR {_CHANGED}""",
    )
)
def snapshot_check(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf, check_columns=["total_amount", "store_id"])


# --- stored tables ------------------------------------------------------------------
@query(sql("fact", "SELECT * FROM fact"))
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = csv_export.export_path(fresh_path(spark, "export"), inputs.AS_OF.date(), "20010801")
    csv_export.export_csv(inputs.fact(spark, sf), path, FACT_COLUMNS)
    return files.read_stage_csv(spark, path, schema_of(FACT_COLUMNS))


@query(sql("sales", "SELECT * FROM sales WHERE etl_batch_id = '199806'"))
def partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "extract")
    rows = written(inputs.sales(spark, sf), "sales")
    partitions.replace_slices(rows, path, ["etl_batch_id", "region"])
    again = rows.filter(F.col("etl_batch_id") == "199806")
    partitions.replace_slices(again, path, ["etl_batch_id", "region"])
    return extract.read_batch(spark, path, "199806").withColumn("etl_batch_id", F.col("etl_batch_id").cast("string"))


@query(
    sql(
        "old_fact new_fact",
        """SELECT * FROM old_fact WHERE sale_year * 100 + sale_month NOT IN (SELECT sale_year * 100 + sale_month FROM new_fact)
UNION ALL SELECT * FROM new_fact""",
    )
)
def insert_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "fact")
    fact_table.write_fact(inputs.old_fact(spark, sf), path)
    partitions.replace_slices(
        inputs.fact_of(inputs.after_cut(spark, sf), inputs.AS_OF), path, fact_table.PARTITION_BY
    )
    return fact_table.read_fact(spark, path)


@query(sql("fact", "SELECT * FROM fact", completed_only=True))
def microbatch_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """The whole fact written slice by slice, from its first month to its last."""
    path = fresh_path(spark, "fact")
    fact = written(inputs.fact(spark, sf, completed_only=True), "fact")
    bounds = fact.agg(
        F.to_date(F.trunc(F.min("sale_date"), "month")).alias("first"),
        F.add_months(F.trunc(F.max("sale_date"), "month"), 1).alias("end"),
    ).first()
    for start, end in incremental.month_slices(bounds.first, bounds.end, 36):
        low, high = (F.lit(edge).cast("timestamp_ntz") for edge in (start, end))
        part = fact.filter((F.col("sale_date") >= low) & (F.col("sale_date") < high))
        partitions.replace_slices(part, path, fact_table.PARTITION_BY)
    return fact_table.read_fact(spark, path)


@query(sql("fact", "SELECT * FROM fact", completed_only=True))
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A table truncated and loaded again: nothing of its first content stays."""
    path = fresh_path(spark, "fact")
    partitions.rebuild(inputs.old_fact(spark, sf, completed_only=True), path)
    partitions.rebuild(inputs.fact(spark, sf, completed_only=True), path)
    return spark.read.schema(schema_of(FACT_COLUMNS)).parquet(path)


@query(sql("fact", "SELECT * FROM fact", completed_only=True))
def contract_write(spark: SparkSession, sf: str) -> DataFrame:
    """A table under contract: rows that keep it are stored, a write with one breaking row changes nothing."""
    path, contract = fresh_path(spark, "fact"), fact_contract()
    rules = {"net amount above the total": F.col("net_amount") <= F.col("total_amount")}
    good = written(inputs.fact(spark, sf, completed_only=True), "fact")
    contracts.rebuild(good, path, contract, rules)
    newest = good.agg(F.max("sale_id").alias("sale_id")).scalar()
    bad = good.withColumn("store_id", F.when(F.col("sale_id") != newest, F.col("store_id")))
    try:
        contracts.rebuild(bad, path, contract, rules)
    except Exception as error:  # noqa: BLE001 (how a failed job is raised depends on the deployment)
        if "store_id is missing" not in str(error):
            raise
    else:
        raise AssertionError("a row without a store entered the table")
    return spark.read.schema(schema_of(FACT_COLUMNS)).parquet(path)


def fact_contract() -> StructType:
    """The fact's columns and types; keys, dates and the region are required."""
    required = ("sale_id", "customer_id", "product_id", "store_id", "sale_date", "region")
    return StructType([StructField(f.name, f.dataType, f.name not in required) for f in schema_of(FACT_COLUMNS)])


@query(
    sql(
        "fact",
        f"SELECT region, payment_method, count(*) AS sale_count, {money('sum(net_amount)')} AS revenue FROM fact GROUP BY region, payment_method",
        completed_only=True,
    )
)
def sql_over_sources(spark: SparkSession, sf: str) -> DataFrame:
    """A statement over frames that are registered by name."""
    files.register_sources({"tidemark_fact": inputs.fact(spark, sf, completed_only=True)})
    return spark.sql(
        "SELECT region, payment_method, count(*) AS sale_count, CAST(sum(net_amount) AS DECIMAL(18,2)) AS revenue "
        "FROM tidemark_fact GROUP BY region, payment_method"
    )


@query(sql("fact", f"SELECT {_FACT_LIST} FROM fact WHERE sale_year = 1998 AND sale_month = 6 AND region = 'ASIA'"))
def clustered_fact_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "fact")
    fact_table.write_fact(inputs.fact(spark, sf), path)
    month = fact_table.read_fact(spark, path).filter((F.col("sale_year") == 1998) & (F.col("sale_month") == 6))
    return month.filter(F.col("region") == "ASIA")


@query(
    sql(
        "checked",
        "SELECT validation_failure_reason, count(*) AS row_count FROM checked WHERE validation_failure_reason IS NOT NULL GROUP BY 1",
        completed_only=True,
    )
)
def quarantine_table(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "quarantine")
    checked = written(inputs.checked(inputs.completed(spark, sf)), "checked")
    late = F.coalesce(F.col("updated_at") >= F.lit(inputs.CUT), F.lit(False))
    for run_id, rows in (("before", checked.filter(~late)), ("after", checked.filter(late))):
        partitions.write_failures(quarantined(rows), path, run_id)
    return spark.read.parquet(path).groupBy("validation_failure_reason").agg(F.count(F.lit(1)).alias("row_count"))
