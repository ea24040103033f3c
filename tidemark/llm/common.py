"""Helpers the operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import WIDE_FILE_ROWS, written

__all__ = ["SPACE", "WIDE_FILE_ROWS", "WORD", "count_words", "running_total", "salted_join", "single_rows", "smallest_hashes", "spread", "text_batches", "without_rows", "without_space", "written"]

# Rows and bytes of an Arrow batch of texts, which tasks hold in the JVM and in Python at once.
BATCH_ROWS = 500
BATCH_BYTES = 2_000_000

# White space as the contracts have it, and a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def without_space(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(text, SPACE, "")


def count_words(text: Column) -> Column:
    """Words of a text that is not null: gaps that begin a word, counted without building the words."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def running_total(df: DataFrame, order: list[str], value: str, out: str, purpose: str, rows: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before it in ``order``, as ``out``.

    A range shuffle deals sorted rows out evenly; totals run within a part, and
    one row per part gives the parts' offsets. The parts are stored, so a lost
    executor cannot move their bounds between the two uses. Nulls come last.
    ``rows``, if known, bounds the files.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    placed = written(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), purpose, rows)
    totals = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(offsets, "_part")
        .withColumn(out, (F.col("_offset") + F.coalesce(F.sum(value).over(within), F.lit(0))).cast("long"))
        .drop("_part", "_offset")
    )


def salted_join(
    df: DataFrame, small: DataFrame, on: list[str], by: Column, how: str = "inner", salts: int = 16, grows: bool = False
) -> DataFrame:
    """Join on keys of which one may hold a large share of ``df``: ``small`` is repeated once per salt.

    Spark does not count the repeats when it sizes a broadcast, so a side that
    ``grows`` with the data is always joined by merging.
    """
    left = df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge") if grows else right, [*on, "_salt"], how).drop("_salt")


def smallest_hashes(rows: DataFrame, counts: DataFrame, by: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows for each value of ``by``, those with the smallest hashes of ``key``.

    ``counts`` holds ``by`` and how many rows it has (``_rows``). Hashes are
    evenly spread, so twice as many as asked for are below a bound that follows
    from the count. Only these are ranked, however many rows a value has.
    """
    bound = F.least(F.lit(1.0), 2.0 * most / F.col("_rows")) * float(1 << 32)
    hash32 = F.xxhash64(key).bitwiseAND(F.lit((1 << 32) - 1))
    near = salted_join(rows, counts, [by], F.col(key)).filter(hash32 < bound).drop("_rows")
    first = Window.partitionBy(by).orderBy(hash32, key)
    return near.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= most).drop("_n")


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that start here hand texts to Python in small Arrow batches.

    Spark's batches of 10,000 rows are tens of MB of texts, doubled as a batch
    grows, per running task. Their native memory stays with the executor and
    adds to a heap that may be full, as do their copies in the Python worker.
    Only for tasks whose results do not depend on batches.
    """
    conf = spark.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    held = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    }
    before = {name: conf.get(name) for name in held}
    for name, value in held.items():
        conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            conf.set(name, value)


def spread(rows: int, each: int) -> int:
    """How many groups of about ``each`` rows hold ``rows``."""
    return max(1, math.ceil(rows / each))


def single_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` with ``__hash`` (of the text), rows of one id and one text reduced to one of them.

    ``keys`` holds doc_id and text_hash of every row. Only ids that repeat are
    regrouped, so texts move only for them.
    """
    many = keys.groupBy("doc_id", "text_hash").count().filter("count > 1")
    doubles = written(many.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__again")), "doubles")
    hashed = docs.withColumn("__hash", F.xxhash64("text"))
    again = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__again"))
    return hashed.join(doubles, again, "left_anti").unionByName(
        hashed.join(doubles, again, "left_semi").dropDuplicates(["doc_id", "__hash"])
    )


def without_rows(docs: DataFrame, keys: DataFrame, gone: str) -> DataFrame:
    """``docs`` without the rows for which ``gone`` holds in ``keys`` (doc_id, text_hash), one row per id and text."""
    out = keys.groupBy("doc_id", "text_hash").agg(F.min(F.expr(gone)).alias("__gone")).filter("__gone")
    listed = written(out.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__out")), "gone", keys.count())
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__out"))
    return single_rows(docs, keys).join(listed, same, "left_anti").select(*docs.columns)
