"""Incremental extracts from regional transaction tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import batch_window
from tidemark.schemas import COMPLETED, EXTRACT_COLUMNS, SOURCE_COLUMNS


def extract_window(source: DataFrame, as_of: dt.date, completed_only: bool = True, more: Sequence[str] = ()) -> DataFrame:
    """Rows changed in the day before ``as_of``, in the source's fixed columns and ``more``.

    The conditions are plain comparisons on stored columns, so parquet and JDBC
    readers evaluate them at the source.
    """
    window = batch_window(as_of)
    start, end = (F.lit(edge).cast("timestamp_ntz") for edge in (window.start, window.end))
    rows = source.filter((F.col("updated_at") >= start) & (F.col("updated_at") < end))
    if completed_only:
        rows = rows.filter(F.col("status") == COMPLETED)
    return rows.select(*SOURCE_COLUMNS, *more)


def consolidate(extracts: Mapping[str, DataFrame], batch_id: str) -> DataFrame:
    """Union of regional extracts, each tagged with its region and the batch.

    One plan over all regions: their scans run side by side in one job.
    """
    tagged = [
        df.withColumns({"region": F.lit(region), "etl_batch_id": F.lit(batch_id)}).select(*EXTRACT_COLUMNS)
        for region, df in extracts.items()
    ]
    return reduce(DataFrame.unionByName, tagged)


def extract_regions(sources: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Extract one day from every regional source and consolidate."""
    return consolidate(
        {region: extract_window(source, as_of) for region, source in sources.items()},
        batch_window(as_of).batch_id,
    )


def read_batch(spark: SparkSession, path: str, batch_id: str, schema: StructType | None = None) -> DataFrame:
    """One batch of a table stored by batch id; other batches are not read.

    Give the schema, or Spark takes batch ids of digits for numbers.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).filter(F.col("etl_batch_id") == batch_id)


def jdbc_source(spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A transaction table in a database reached over JDBC.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in ``options`` to read it in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**dict(options or {})).load()
