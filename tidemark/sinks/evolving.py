"""Tables whose schema changes while rows stay as they were written.

A table is a folder of generations of parquet files and its current schema
beside it. Appending under a policy settles the schema first and then adds
files; older ones are never rewritten. Reading asks every file for the current
schema: columns a file lacks are NULL, those the table no longer has are not
read, and narrower types of older files are widened by the reader.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField, StructType, TimestampNTZType

from tidemark.operators.merge import SchemaChangeError, merged_columns
from tidemark.sinks.fact_table import exists

# What a type may become while files of the old type stay.
WIDER = {
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
    DateType: (TimestampNTZType,),
}


def _schema_path(path: str) -> str:
    return f"{path}__schema"


def table_schema(spark: SparkSession, path: str) -> StructType | None:
    """The current schema of a table, nothing if there is no table."""
    if not exists(spark, _schema_path(path)):
        return None
    return StructType.fromJson(json.loads(spark.read.text(_schema_path(path)).first().value))


def _set_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(_schema_path(path))


def wider(stored: DataType, incoming: DataType) -> DataType:
    """The type that holds both; an error if one cannot be read as the other."""
    if stored == incoming:
        return stored
    if isinstance(stored, DecimalType) and isinstance(incoming, DecimalType):
        scale = max(stored.scale, incoming.scale)
        whole = max(stored.precision - stored.scale, incoming.precision - incoming.scale)
        if whole + scale <= DecimalType(38).precision:
            return DecimalType(whole + scale, scale)
    elif isinstance(incoming, WIDER.get(type(stored), ())):
        return incoming
    elif isinstance(stored, WIDER.get(type(incoming), ())):
        return stored
    raise SchemaChangeError(f"{incoming.simpleString()} does not go with {stored.simpleString()}")


def settled_schema(stored: StructType, incoming: StructType, policy: str, have: DataFrame, new: DataFrame) -> StructType:
    """The table's schema after rows of another schema have entered it under a policy (see ``merged_columns``)."""
    before, after = ({f.name: f.dataType for f in schema} for schema in (stored, incoming))
    fields = []
    for name in merged_columns(have, new, policy):
        kinds = [types[name] for types in (before, after) if name in types]
        fields.append(StructField(name, wider(*kinds) if len(kinds) == 2 else kinds[0]))
    return StructType(fields)


def append(df: DataFrame, path: str, policy: str = "append_new_columns") -> None:
    """Add rows as a new generation of files, in the schema that the policy gives the table.

    Under ``fail`` nothing is written if the columns differ; types that do not
    go together are an error under every policy.
    """
    spark = df.sparkSession
    stored = table_schema(spark, path)
    schema = StructType([StructField(f.name, f.dataType) for f in df.schema])
    if stored is not None:
        schema = settled_schema(stored, schema, policy, spark.createDataFrame([], stored), df)
    present = set(df.columns)
    rows = df.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    if schema != stored:
        _set_schema(spark, path, schema)
    rows.write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All generations in the table's current schema."""
    return spark.read.schema(table_schema(spark, path)).parquet(path)
