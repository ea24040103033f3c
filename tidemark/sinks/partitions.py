"""Replace slices of partitioned tables; rebuild and append whole ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def replace_slices(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite exactly the partitions that ``df`` has rows for.

    Writing the same slice twice leaves it as after the first time, so a batch
    can be replayed. ``rebalance`` gathers small slices into few files and lets
    Spark split a slice that holds far more rows than the others.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def rebuild(df: DataFrame, path: str) -> None:
    """Replace a whole table (dimensions, full refresh, truncate-and-load)."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Add rows to a table."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def replace_run(df: DataFrame, path: str, run: str, run_id: str, by: Sequence[str] = ()) -> None:
    """Replace all that one run stored, its other slices too, and nothing of other runs.

    ``run`` is the column that names the run; all rows belong to ``run_id``.
    A run without rows leaves none.
    """
    (
        df.drop(run)
        .hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .parquet(f"{path}/{run}={run_id}")
    )


def write_failures(failing: DataFrame, path: str, run_id: str, by: str = "validation_failure_reason") -> None:
    """Store the failing rows of a run, one partition per reason; those of other runs stay."""
    replace_run(failing, path, "run_id", run_id, [by])
