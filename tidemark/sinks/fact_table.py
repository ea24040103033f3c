"""The fact table on parquet: month partitions, clustered by day and region.

A merge rewrites only partitions it touches:

1. locate: which partitions hold a changed key now, and which will after the merge
2. merge those partitions with the changes, into the folder of this attempt
3. publish that folder over the table with dynamic partition overwrite, and
   drop touched partitions that have no rows left

A table may also be partitioned by a hash of its key (``buckets``). Then locating
reads the key column of the buckets that changes fall into and no other, and
only those buckets of a touched month are rewritten: a small batch costs what
it changes. The number of buckets is the table's own and is found in its folder.

Two kinds of tables can be kept beside a fact from its merges alone, without
reading the fact again: daily KPIs (``daily``) and the version history
(``history``). What changes in them is staged with the merge and published with
it, so they never tell another story than the fact.

Every attempt has a folder of its own on shared storage, marked once it is
complete and once it is published. An attempt that died during step 3 is
published first by whatever merge comes next; everything else is computed from
the table as it is then, so no merge brings back months older than the table.
A published folder is deleted after the next one. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from tidemark.operators import daily_state, version_log
from tidemark.operators.merge import ACTION, BEFORE, SIGN, live_rows, merge_changes, merge_newest, merge_tally, signed_images
from tidemark.schemas import FACT_COLUMNS, schema_of
from tidemark.session import shared_dir, written

PARTITION_BY = ["sale_year", "sale_month"]
CLUSTER_BY = ["sale_date", "region"]
# Markers in the folder of an attempt, and what parts its run id from the rest of its name.
STAGED, PUBLISHED, SEPARATOR = "_STAGED", "_PUBLISHED", "--"
# Marker of a kept table that has been filled.
FILLED = "_FILLED"
# The partition column of a bucketed table, and the marker in its folder that says how many buckets it has.
KEY_BUCKET, BUCKETS = "key_bucket", "_buckets-"
# Partition of an attempt that holds the rows that a merge changes.
CHANGED = "_changed"
TOMBSTONE_FACT_COLUMNS = [*FACT_COLUMNS, "is_deleted", "_kafka_offset"]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``?"""
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def _drop_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def _month() -> Column:
    return F.coalesce(F.col("sale_year") * 100 + F.col("sale_month"), F.lit(-1))


def table_buckets(spark: SparkSession, path: str) -> int:
    """How many key buckets a table has, 1 if it is not bucketed."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return 1
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return max([int(name.removeprefix(BUCKETS)) for name in names if name.startswith(BUCKETS)], default=1)


def cell_columns(buckets: int) -> list[str]:
    """The partition columns of a table."""
    return [*PARTITION_BY, KEY_BUCKET] if buckets > 1 else list(PARTITION_BY)


def with_bucket(df: DataFrame, buckets: int, keys: Sequence[str] = ("sale_id",)) -> DataFrame:
    """``df`` with the bucket of its key, unchanged for a table that has none."""
    return df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")) if buckets > 1 else df


def _cell(buckets: int) -> Column:
    """A partition as one number."""
    return _month() * F.lit(buckets).cast("bigint") + F.col(KEY_BUCKET) if buckets > 1 else _month()


def _create(spark: SparkSession, path: str, buckets: int) -> None:
    """Empty the folder of a table and note its buckets, before any row is there."""
    _drop_folder(spark, path)
    if buckets > 1:
        _mark(spark, f"{path}/{BUCKETS}{buckets}")


def write_fact(fact: DataFrame, path: str, buckets: int = 1, keys: Sequence[str] = ("sale_id",)) -> None:
    """Write a whole fact table.

    Ranges end in the sale id, so a month, day or region with a large share of
    the rows is spread over several tasks; rows of a file are ordered by day
    and region, which keeps row-group statistics narrow. With buckets, choose
    as many as make a month's bucket a few hundred megabytes.
    """
    spark = fact.sparkSession
    ordered = [*cell_columns(buckets), *CLUSTER_BY, "sale_id"]
    ready = with_bucket(fact, buckets, keys).repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    if buckets == 1 and table_buckets(spark, path) == 1:
        ready.write.mode("overwrite").partitionBy(*PARTITION_BY).parquet(path)
        return
    _create(spark, path, buckets)
    ready.write.mode("append").partitionBy(*cell_columns(buckets)).parquet(path)


def read_fact(spark: SparkSession, path: str, columns: Sequence[str] = tuple(FACT_COLUMNS)) -> DataFrame:
    """Read a fact table with its declared schema."""
    return spark.read.schema(schema_of(list(columns))).parquet(path).select(*columns)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The daily KPIs kept beside the fact table at ``path``."""
    stored = spark.read.schema(daily_state.DAILY_DDL).parquet(f"{_daily_path(path)}/kpis")
    return stored.select(*daily_state.DAILY_COLUMNS)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Every version kept beside the fact table at ``path``, with its validity."""
    return version_log.versions_with_ends(*_log(spark, path))


def _daily_path(path: str) -> str:
    return f"{path}__daily"


def _history_path(path: str) -> str:
    return f"{path}__history"


def _log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Opened versions and closures of a table's history."""
    root = _history_path(path)
    opened = spark.read.schema(version_log.opened_schema(schema_of(FACT_COLUMNS))).parquet(f"{root}/opened")
    closed = spark.read.schema(version_log.CLOSED_DDL).parquet(f"{root}/closed")
    return opened, closed


def touched_cells(target: DataFrame, changes: DataFrame, buckets: int = 1, keys: Sequence[str] = ("sale_id",)) -> DataFrame:
    """Partitions that hold a changed key, before or after the merge.

    Scans the key column only, and of a bucketed table only the buckets that
    the changes fall into: these are few values, so they reach the scan as a
    partition filter however many keys there are.
    """
    cells = cell_columns(buckets)
    if buckets > 1:
        target = target.join(changes.select(KEY_BUCKET).filter(F.col(KEY_BUCKET) >= 0).distinct(), KEY_BUCKET, "left_semi")
    now = target.select(*keys, *cells).join(changes.select(*keys), on=list(keys), how="left_semi")
    return now.select(*cells).unionByName(changes.select(*cells)).distinct()


def in_cells(table: DataFrame, cells: DataFrame, buckets: int = 1) -> DataFrame:
    """Rows of a table in given partitions; a join on the partition columns, so Spark prunes the scan by it.

    Every partition passes the comparison; Spark prunes by a side only if that is filtered.
    """
    wanted = cells.select(_cell(buckets).alias("_wanted")).filter(F.col("_wanted") >= -buckets)
    return table.join(wanted, _cell(buckets) == F.col("_wanted"), "left_semi")


def merge_into_fact(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    as_of: dt.datetime,
    run_id: str,
    newest_only: bool = False,
    keys: Sequence[str] = ("sale_id",),
    once: bool = False,
    buckets: int = 1,
    daily: bool = False,
    history: bool = False,
) -> DataFrame:
    """Merge one change per key into the table at ``path``; returns the tally row.

    With ``newest_only`` the table keeps tombstones and late changes are
    ignored (see ``merge_newest``). A run id that comes again is merged again,
    into the table as it is now. With ``once`` it names the same changes each
    time, and if it was the last to be published only its tally is returned.

    ``buckets`` is for a table that does not exist yet; others keep theirs.
    ``daily`` and ``history`` keep the tables that ``read_daily`` and
    ``read_history`` read. They are filled from the stored fact once if they
    are new, and from then on every merge has to name them. A history counts a
    version as changed if its ``updated_at`` is newer, and closes a deleted
    key's version at ``as_of``.
    """
    columns = TOMBSTONE_FACT_COLUMNS if newest_only else FACT_COLUMNS
    schema = schema_of(columns)
    runs = _runs(spark, path)
    earlier = _attempts(spark, runs)
    for attempt in earlier:
        if exists(spark, f"{attempt}/{STAGED}") and not exists(spark, f"{attempt}/{PUBLISHED}"):
            _publish(spark, path, attempt, schema, newest_only)
    done = _published(spark, earlier, run_id) if once else None
    if done is not None:
        return written(merge_tally(_staged(spark, done, schema)), "tally")
    for kept, root in ((daily, _daily_path(path)), (history, _history_path(path))):
        if not kept and exists(spark, f"{root}/{FILLED}"):
            raise ValueError(f"{root} is kept from the merges into {path}; this merge leaves it out")
    attempt = f"{runs}/{run_id}{SEPARATOR}{uuid.uuid4().hex}"
    _stage_merge(spark, path, schema, changes, as_of, attempt, newest_only, keys, buckets, daily, history)
    _publish(spark, path, attempt, schema, newest_only)
    for old in earlier:
        _drop_folder(spark, old)
    return written(merge_tally(_staged(spark, attempt, schema)), "tally")


def _runs(spark: SparkSession, path: str) -> str:
    return f"{shared_dir(spark)}/tidemark/merge/{hashlib.md5(path.encode()).hexdigest()}"


def _published(spark: SparkSession, attempts: Sequence[str], run_id: str) -> str | None:
    """The published attempt of a run, if it is still there."""
    of_run = [a for a in attempts if a.rsplit("/", 1)[-1].startswith(f"{run_id}{SEPARATOR}")]
    return next((a for a in of_run if exists(spark, f"{a}/{PUBLISHED}")), None)


def is_merged(spark: SparkSession, path: str, run_id: str) -> bool:
    """Was this run the last to be merged into the table?"""
    return _published(spark, _attempts(spark, _runs(spark, path)), run_id) is not None


def _attempts(spark: SparkSession, runs: str) -> list[str]:
    """Folders of the merges into a table: the last published one, and what a failure left."""
    fs, hadoop_path = _fs(spark, runs)
    if not fs.exists(hadoop_path):
        return []
    return [f"{runs}/{status.getPath().getName()}" for status in fs.listStatus(hadoop_path)]


def _mark(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.createNewFile(hadoop_path)


def _staged(spark: SparkSession, attempt: str, schema: StructType) -> DataFrame:
    """What an attempt did with every row of the partitions it touches."""
    more = [StructField(ACTION, StringType()), StructField(BEFORE, schema), StructField(CHANGED, BooleanType())]
    return spark.read.schema(StructType([*schema.fields, *more])).parquet(f"{attempt}/rows")


def _stage_merge(
    spark: SparkSession,
    path: str,
    schema: StructType,
    changes: DataFrame,
    as_of: dt.datetime,
    attempt: str,
    newest_only: bool,
    keys: Sequence[str],
    buckets: int,
    daily: bool,
    history: bool,
) -> None:
    stored = exists(spark, path)
    if stored:
        buckets = table_buckets(spark, path)
    elif buckets > 1:
        _create(spark, path, buckets)
    cells = cell_columns(buckets)
    changes = written(with_bucket(changes, buckets, keys), "changes")
    with_cells = StructType([*schema.fields, *[StructField(KEY_BUCKET, IntegerType()) for _ in cells[2:]]])
    target = spark.read.schema(with_cells).parquet(path) if stored else spark.createDataFrame([], with_cells)
    touched_cells(target, changes, buckets, keys).write.parquet(f"{attempt}/cells")
    if stored:
        target = in_cells(target, _cells(spark, attempt, "cells"), buckets)
    merge = merge_newest if newest_only else merge_changes
    feeds = daily or history
    actions = merge(target.select(*schema.names), changes, as_of, keys=keys, before=feeds)
    # Rows that change lie in folders of their own, so that what is kept beside the table reads nothing else.
    changed = F.lit(feeds) & F.col(ACTION).isin("insert", "update", "delete")
    (
        with_bucket(actions, buckets, keys)
        .withColumn(CHANGED, changed)
        .hint("rebalance", *cells)
        .sortWithinPartitions(CHANGED, *cells, *CLUSTER_BY)
        .write.partitionBy(CHANGED, *cells)
        .parquet(f"{attempt}/rows")
    )
    if daily:
        _stage_daily(spark, path, schema, as_of, attempt, newest_only, stored)
    if history:
        _stage_history(spark, path, schema, as_of, attempt, newest_only, keys, stored)
    _mark(spark, f"{attempt}/{STAGED}")


def _live_fact(spark: SparkSession, path: str, schema: StructType, newest_only: bool) -> DataFrame:
    fact = read_fact(spark, path, schema.names)
    return live_rows(fact) if newest_only else fact


def _stage_daily(
    spark: SparkSession, path: str, schema: StructType, as_of: dt.datetime, attempt: str, newest_only: bool, stored: bool
) -> None:
    """Stage the months of state and KPIs that the attempt's changed rows touch."""
    month, root = daily_state.MONTH, _daily_path(path)
    if not exists(spark, f"{root}/{FILLED}"):
        _drop_folder(spark, root)
        if stored:
            now = _live_fact(spark, path, schema, newest_only).withColumn(SIGN, F.lit(1))
            _write_cells(daily_state.combined([daily_state.state_changes(now, as_of)]), f"{root}/state", [month])
            first = spark.read.schema(daily_state.STATE_DDL).parquet(f"{root}/state")
            _write_cells(daily_state.daily_of_state(first), f"{root}/kpis", [month])
        _mark(spark, f"{root}/{FILLED}")
    images = signed_images(_staged(spark, attempt, schema).filter(CHANGED), daily_state.SOURCE_COLUMNS)
    change = written(daily_state.state_changes(images, as_of), "state-changes")
    change.select(month).distinct().write.parquet(f"{attempt}/months")
    states = [change]
    if exists(spark, f"{root}/state"):
        before = spark.read.schema(daily_state.STATE_DDL).parquet(f"{root}/state")
        wanted = _cells(spark, attempt, "months", f"{month} int").select(F.coalesce(month, F.lit(-1)).alias("_wanted")).filter("_wanted >= -1")
        states.append(before.join(wanted, F.coalesce(month, F.lit(-1)) == F.col("_wanted"), "left_semi"))
    _write_cells(daily_state.combined([s.select(*states[0].columns) for s in states]), f"{attempt}/state", [month])
    after = spark.read.schema(daily_state.STATE_DDL).parquet(f"{attempt}/state")
    _write_cells(daily_state.daily_of_state(after), f"{attempt}/kpis", [month])


def _stage_history(
    spark: SparkSession,
    path: str,
    schema: StructType,
    as_of: dt.datetime,
    attempt: str,
    newest_only: bool,
    keys: Sequence[str],
    stored: bool,
) -> None:
    """Stage the versions that the attempt's changed rows open and close."""
    root, fact = _history_path(path), schema_of(FACT_COLUMNS)
    if not exists(spark, f"{root}/{FILLED}"):
        _drop_folder(spark, root)
        now = _live_fact(spark, path, schema, newest_only).select(*fact.names) if stored else spark.createDataFrame([], fact)
        version_log.first_versions(now).write.parquet(f"{root}/opened/run=first")
        spark.createDataFrame([], version_log.CLOSED_DDL).drop("run").write.parquet(f"{root}/closed/run=first")
        _mark(spark, f"{root}/{FILLED}")
    changed = _staged(spark, attempt, schema).filter(CHANGED).select(*fact.names, ACTION)
    pairs = written(version_log.with_open_versions(changed, *_log(spark, path), keys=keys), "open-versions")
    version_log.opened(pairs, fact.names).write.parquet(f"{attempt}/opened")
    version_log.closed(pairs, as_of).write.parquet(f"{attempt}/closed")


def _write_cells(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    rows.hint("rebalance", *by).sortWithinPartitions(*by).write.partitionBy(*by).parquet(path)


def _cells(spark: SparkSession, attempt: str, name: str, ddl: str | None = None) -> DataFrame:
    """Touched partitions that an attempt has noted."""
    return spark.read.schema(ddl or f"sale_year int, sale_month int, {KEY_BUCKET} int").parquet(f"{attempt}/{name}")


def _publish(spark: SparkSession, path: str, attempt: str, schema: StructType, newest_only: bool) -> None:
    """Put what an attempt has staged in its place. Everything is replaced whole, so doing it again changes nothing."""
    buckets = table_buckets(spark, path)
    cells = cell_columns(buckets)
    staged = _staged(spark, attempt, StructType([*schema.fields, *[StructField(KEY_BUCKET, IntegerType()) for _ in cells[2:]]]))
    remaining = staged if newest_only else staged.filter(~F.col(ACTION).isin("delete", "skip"))
    remaining = remaining.select(*schema.names, *cells[2:])
    # The staged files hold a partition each, so they are written on without a shuffle.
    _overwrite(remaining.sortWithinPartitions(*cells, *CLUSTER_BY), path, cells)
    _drop_emptied(spark, path, _cells(spark, attempt, "cells"), remaining, cells)
    if exists(spark, f"{attempt}/kpis"):
        months = _cells(spark, attempt, "months", f"{daily_state.MONTH} int")
        for name, ddl in (("state", daily_state.STATE_DDL), ("kpis", daily_state.DAILY_DDL)):
            _replace_cells(spark, f"{attempt}/{name}", ddl, f"{_daily_path(path)}/{name}", [daily_state.MONTH], months)
    if exists(spark, f"{attempt}/closed"):
        run = attempt.rsplit("/", 1)[-1]
        for name in ("opened", "closed"):
            rows = spark.read.parquet(f"{attempt}/{name}")
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{_history_path(path)}/{name}/run={run}")
    _mark(spark, f"{attempt}/{PUBLISHED}")


def _overwrite(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _replace_cells(spark: SparkSession, staged: str, ddl: str, path: str, by: Sequence[str], touched: DataFrame) -> None:
    """Replace partitions of a table by staged ones, and drop touched ones that have no rows any more."""
    rows = spark.read.schema(ddl).parquet(staged)
    _overwrite(rows.sortWithinPartitions(*by), path, by)
    _drop_emptied(spark, path, touched, rows, by)


def _drop_emptied(spark: SparkSession, path: str, touched: DataFrame, rows: DataFrame, by: Sequence[str]) -> None:
    """Drop touched partitions without rows: dynamic overwrite leaves them alone.

    The driver gets one row per emptied partition.
    """
    same = F.concat_ws("/", *[F.coalesce(F.col(name).cast("string"), F.lit("-")) for name in by])
    filled = rows.select(same.alias("_cell")).distinct()
    emptied = touched.withColumn("_cell", same).join(filled, on="_cell", how="left_anti").select(*by)
    for row in emptied.collect():
        names = ["__HIVE_DEFAULT_PARTITION__" if v is None else v for v in row]
        _drop_folder(spark, f"{path}/" + "/".join(f"{column}={name}" for column, name in zip(by, names, strict=True)))
