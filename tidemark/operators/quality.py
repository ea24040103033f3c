"""Data tests: each states a condition, every failing row or group counts.

Row-level tests of one table (not null, accepted values, ranges, patterns)
share a single aggregation pass. Uniqueness and references first reduce to one
row per key, so repeated keys do not pile up in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import written

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class RowTest:
    """A named condition; rows where ``fails`` is TRUE break it."""

    name: str
    column: str
    fails: Column
    severity: str = ERROR


def not_null(column: str, severity: str = ERROR) -> RowTest:
    """The column must have a value."""
    return RowTest("not_null", column, F.col(column).isNull(), severity)


def accepted_values(column: str, values: Sequence[str], severity: str = ERROR) -> RowTest:
    """The column must hold one of the values; NULL is not judged."""
    return RowTest("accepted_values", column, ~F.col(column).isin(*values), severity)


def between(column: str, low=None, high=None, severity: str = ERROR) -> RowTest:
    """The column must lie within the given bounds; NULL is not judged."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    return RowTest("between", column, outside, severity)


def positive_value(column: str, severity: str = ERROR) -> RowTest:
    """The column must not be below zero; NULL is not judged."""
    return RowTest("positive_value", column, F.col(column) < 0, severity)


def length_between(column: str, low: int, high: int, severity: str = ERROR) -> RowTest:
    """The text length must lie within the bounds."""
    return RowTest("length_between", column, ~F.length(column).between(low, high), severity)


def matches(column: str, pattern: str, severity: str = ERROR) -> RowTest:
    """The text must match a regular expression."""
    return RowTest("matches", column, ~F.col(column).rlike(pattern), severity)


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, "pass").when(severity == WARN, "warn").otherwise("fail")


def _finish(results: DataFrame) -> DataFrame:
    return results.withColumn("status", _status(F.col("failures"), F.col("severity")))


def row_test_results(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    """All row tests of a table in one pass: a result row per test."""
    counts = df.agg(*[F.count_if(test.fails).alias(f"t{i}") for i, test in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(
                F.lit(test.name).alias("test"),
                F.lit(test.column).alias("column_name"),
                F.lit(test.severity).alias("severity"),
                F.col(f"t{i}").alias("failures"),
            )
            for i, test in enumerate(tests)
        ]
    )
    return _finish(counts.select(F.inline(rows)))


def failing_rows(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    """The rows that break at least one test, with the names of those they break."""
    broken = F.filter(
        F.array(*[F.when(test.fails, F.lit(f"{test.name}({test.column})")) for test in tests]),
        lambda name: name.isNotNull(),
    )
    return df.withColumn("failed_tests", broken).filter(F.size("failed_tests") > 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def unique_results(df: DataFrame, column: str, severity: str = ERROR) -> DataFrame:
    """Result row of a uniqueness test; NULLs are not judged."""
    repeated = duplicate_keys(df.filter(F.col(column).isNotNull()), [column])
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")), "unique", column, severity)


def _result(counted: DataFrame, test: str, column: str, severity: str) -> DataFrame:
    return _finish(
        counted.select(
            F.lit(test).alias("test"),
            F.lit(column).alias("column_name"),
            F.lit(severity).alias("severity"),
            F.col("failures"),
        )
    )


def row_count_results(df: DataFrame, low: int, high: int | None = None, severity: str = ERROR, by: str | None = None) -> DataFrame:
    """Result row of a row-count test: how many tables (or, with ``by``, groups) have a count outside the bounds.

    A group that has no rows is no group; count an empty table as a whole.
    """
    counts = df.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("n"))
    outside = F.col("n") < low
    if high is not None:
        outside = outside | (F.col("n") > high)
    return _result(counts.agg(F.count_if(outside).alias("failures")), "row_count_between", by or "*", severity)


def orphan_keys(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with their number of rows.

    Child rows are counted per key before the join, so a hot key is one row in it.
    """
    counts = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("orphan_count"))
    known = parent.select(F.col(parent_column or column).alias(column))
    return counts.join(known, on=column, how="left_anti")


def relationship_results(
    child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None, severity: str = ERROR
) -> DataFrame:
    """Result row of a foreign-key test."""
    orphans = orphan_keys(child, parent, column, parent_column)
    failures = F.coalesce(F.sum("orphan_count"), F.lit(0)).cast("bigint").alias("failures")
    return _result(orphans.agg(failures), "relationships", column, severity)


def run_tests(
    df: DataFrame,
    rows: Sequence[RowTest] = (),
    unique: Sequence[tuple[str, str]] = (),
    references: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """Every test of one table in one result frame.

    ``unique`` lists (column, severity), ``references`` (column, parent, severity).
    """
    parts = [row_test_results(df, rows)] if rows else []
    parts += [unique_results(df, column, severity) for column, severity in unique]
    parts += [relationship_results(df, parent, column, severity=severity) for column, parent, severity in references]
    return reduce(DataFrame.unionByName, parts)


def run_fails(results: DataFrame) -> DataFrame:
    """One row: does any test of severity ``error`` fail?"""
    return results.agg(
        F.count_if(F.col("status") == "fail").alias("failed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
    ).withColumn("run_ok", F.col("failed") == 0)


def missing_days(daily: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Region and day pairs without sales, over recent days that have any sale.

    Each region row generates the recent days itself, and days nobody sold on
    drop out in a semi join, so no join without keys is needed.
    """
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    recent = daily.filter(F.col("sale_date") >= since)
    seen_days = recent.select("sale_date").distinct()
    last_day = recent.agg(F.max("sale_date").alias("last_day")).scalar()
    regions = daily.select("region").distinct()
    calendar = F.when(last_day.isNotNull(), F.sequence(since, last_day, F.expr("interval 1 day")))
    expected = regions.select(F.explode(calendar).alias("sale_date"), "region").join(
        seen_days, on="sale_date", how="left_semi"
    )
    return expected.join(recent.select("sale_date", "region"), on=["sale_date", "region"], how="left_anti")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the frame lacks."""
    return [name for name in required if name not in df.columns]


def contract_breaches(df: DataFrame, contract: StructType) -> list[str]:
    """Differences between a frame and its contract in names and types."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema}
    breaches = []
    for field in contract:
        wanted = field.dataType.simpleString()
        if field.name not in actual:
            breaches.append(f"{field.name}: missing")
        elif actual[field.name] != wanted:
            breaches.append(f"{field.name}: {actual[field.name]} instead of {wanted}")
    breaches += [f"{name}: not in contract" for name in actual if name not in contract.names]
    return breaches


def contract_tests(contract: StructType) -> list[RowTest]:
    """Not-null tests for the contract's required columns."""
    return [not_null(field.name) for field in contract if not field.nullable]


def freshness(
    df: DataFrame,
    as_of: dt.datetime,
    loaded_at: str,
    warn_hours: int,
    error_hours: int,
) -> DataFrame:
    """Age of the newest row against the warn and error limits."""
    now = F.lit(as_of).cast("timestamp_ntz")
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    hour = F.expr("interval 1 hour")
    status = (
        F.when(F.col("max_loaded_at").isNull() | (F.col("max_loaded_at") + hour * error_hours < now), "error")
        .when(F.col("max_loaded_at") + hour * warn_hours < now, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("status", status)


def _fingerprints(df: DataFrame, keys: Sequence[str], others: Sequence[str], name: str) -> DataFrame:
    """Keys and one hash of all other columns; a column that the frame lacks counts as NULL."""
    values = [F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string") for c in others]
    # The hash passes over nulls, so where they stand is hashed with the values.
    return df.select(*keys, F.xxhash64(*values, *[v.isNull() for v in values]).alias(name))


def _outcomes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs of fingerprints ``_l`` and ``_r`` counted per outcome; NULL keys pair with NULL keys."""
    theirs = right.select(*[F.col(key).alias(f"_r_{key}") for key in keys], "_r")
    same_key = [F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys]
    outcome = (
        F.when(F.col("_r").isNull(), "only_left")
        .when(F.col("_l").isNull(), "only_right")
        .when(F.col("_l") == F.col("_r"), "same")
        .otherwise("different")
    )
    paired = left.join(theirs, on=same_key, how="full_outer")
    return paired.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"))


def compare_relations(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How two versions of a keyed table differ, counted per outcome.

    Rows are compared through a hash of all other columns of either side, so
    only keys and one number per row are shuffled. A column that one side lacks
    counts as NULL there.
    """
    others = [name for name in dict.fromkeys([*left.columns, *right.columns]) if name not in keys]
    return _outcomes(_fingerprints(left, keys, others, "_l"), _fingerprints(right, keys, others, "_r"), keys)


def compare_by_segments(left: DataFrame, right: DataFrame, keys: Sequence[str], segments: int = 4096) -> DataFrame:
    """``compare_relations`` for large tables that are mostly alike.

    Keys are dealt into segments by a hash. Count, sum and exclusive or of the
    rows' hashes are taken per segment and side in one aggregation, which leaves
    each task as a row per segment. Only rows of segments that differ are then
    paired; of the others nothing but these digests is shuffled.
    """
    others = [name for name in dict.fromkeys([*left.columns, *right.columns]) if name not in keys]
    segment = F.pmod(F.xxhash64(*keys), F.lit(segments)).cast("int").alias("_segment")
    sides = {name: _fingerprints(df, keys, others, name) for name, df in (("_l", left), ("_r", right))}
    marked = [df.select(segment, F.xxhash64(*keys, name).alias("_row"), F.lit(name).alias("_side")) for name, df in sides.items()]

    def of(side: str, row: Column) -> Column:
        return F.when(F.col("_side") == side, row)

    digests = (
        marked[0]
        .unionByName(marked[1])
        .groupBy("_segment")
        .agg(
            *[F.count(of(s, F.lit(1))).alias(f"n{s}") for s in sides],
            *[F.coalesce(F.sum(of(s, F.col("_row").cast("decimal(20,0)"))), F.lit(0)).cast("decimal(38,0)").alias(f"sum{s}") for s in sides],
            *[F.coalesce(F.bit_xor(of(s, F.col("_row"))), F.lit(0)).alias(f"xor{s}") for s in sides],
        )
    )
    alike = (F.col("n_l") == F.col("n_r")) & (F.col("sum_l") == F.col("sum_r")) & (F.col("xor_l") == F.col("xor_r"))
    stored = written(digests.select("_segment", F.col("n_l").alias("n"), alike.alias("alike")), "segments")
    apart = stored.filter(~F.col("alike")).select("_segment")
    narrowed = [df.withColumn("_segment", segment).join(apart, "_segment", "left_semi").drop("_segment") for df in sides.values()]
    same = stored.filter("alike").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(F.lit("same").alias("outcome"), "row_count")
    both = _outcomes(narrowed[0], narrowed[1], keys).unionByName(same)
    return both.groupBy("outcome").agg(F.sum("row_count").alias("row_count")).filter("row_count > 0")


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side the other lacks (counted with duplicates), labelled by side."""
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.select(*left.columns).withColumn("_side", F.lit(-1)))
    surplus = sides.groupBy(*left.columns).agg(F.sum("_side").alias("_side")).filter("_side != 0")
    repeated = F.explode(F.array_repeat(F.when(F.col("_side") > 0, "left").otherwise("right"), F.abs("_side").cast("int")))
    return surplus.select(*left.columns, repeated.alias("side"))
