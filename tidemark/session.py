"""Session settings and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. All are also Spark defaults except the
# first; they are repeated so that a cluster profile which turned one off is
# put right for sessions built here.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}

# Rows in a file of a stored table of a few numbers a row, and of one whose rows hold arrays.
FILE_ROWS = 20_000
WIDE_FILE_ROWS = 5_000

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh
    temporary folder, since driver and executors are one process there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[context.applicationId]


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tidemark/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, rows: int | None = None, each: int = FILE_ROWS) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one result feeds several later jobs: lineage is cut, and an
    executor that is lost costs only the tasks it was running.

    A task writes a file, and on a local file system each file starts a process
    to set its mode, which counts an executor's memory twice while it starts.
    Where the caller knows about how many ``rows`` there are at most, files are
    as many as these need with ``each`` rows in one, or one a core, and no more.
    """
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / each)))
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
