"""Staged CSV, seed CSV, region configuration and named sources."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import NULL_TOKENS, PAYMENT_METHOD_DDL, REGION_CONFIG_DDL
from tidemark.session import fresh_path

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_stage_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headerless comma CSV in the column order of ``schema``.

    Empty fields and the NULL tokens read as NULL. Fields are read as text and
    cast afterwards, since the reader itself knows a single NULL token; a value
    that does not fit its type, or a row of another width, stops the read.
    """
    text = StructType()
    for field in schema:
        text = text.add(field.name, "string")
    rows = (
        spark.read.schema(text)
        .option("header", "false")
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
    cleaned = []
    for field in schema:
        value = F.col(field.name)
        value = F.when(~value.isin(*NULL_TOKENS), value)
        if field.dataType.typeName() == "timestamp_ntz":
            value = F.to_timestamp_ntz(value, F.lit(CSV_TIMESTAMP))
        elif field.dataType.typeName() != "string":
            value = value.cast(field.dataType)
        cleaned.append(value.alias(field.name))
    return rows.select(*cleaned)


def shipped(spark: SparkSession, name: str) -> str:
    """Where every executor finds a file of ``tidemark/config``: its lines are put into the shared folder first."""
    lines = (Path(__file__).resolve().parents[1] / "config" / name).read_text().splitlines()
    path = fresh_path(spark, name)
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def read_seed(spark: SparkSession, path: str, ddl: str = PAYMENT_METHOD_DDL) -> DataFrame:
    """A reference table from a CSV file with a header line."""
    return spark.read.schema(ddl).option("header", "true").option("mode", "FAILFAST").csv(path)


def read_region_config(spark: SparkSession, path: str) -> DataFrame:
    """One row per configured region from a JSON file ``{"regions": [...]}``."""
    config = spark.read.schema(f"regions array<struct<{_struct_ddl(REGION_CONFIG_DDL)}>>").json(path, multiLine=True)
    return config.select(F.inline("regions"))


def _struct_ddl(ddl: str) -> str:
    return ", ".join(part.strip().replace(" ", ": ", 1) for part in ddl.split(","))


def with_region_names(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Replace region codes by the configured display names; unknown ones become NULL.

    The configuration comes from a small file, so Spark, which knows its size,
    broadcasts it without being told to.
    """
    names = regions.select(F.col("name").alias("region"), "display_name")
    columns = [F.col("display_name").alias("region") if c == "region" else F.col(c) for c in df.columns]
    return df.join(names, on="region", how="left").select(*columns)


def register_sources(frames: Mapping[str, DataFrame]) -> None:
    """Make frames addressable by name in SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
