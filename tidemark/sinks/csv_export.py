"""Headerless CSV export of one batch, ordered by key across part files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.sources.files import CSV_TIMESTAMP


def export_path(root: str, day: dt.date, batch_id: str) -> str:
    """Where a batch's export lies: keyed by run date and batch."""
    return f"{root}/sales_data/{day.isoformat()}/sales_data_{batch_id}.csv"


def export_csv(df: DataFrame, path: str, columns: Sequence[str], order_by: str = "sale_id") -> None:
    """Write comma CSV without header.

    Part files hold consecutive key ranges and are sorted inside, so reading
    them in name order gives a total order without a single writing task.
    """
    (
        df.select(*columns)
        .repartitionByRange(order_by)
        .sortWithinPartitions(order_by)
        .write.mode("overwrite")
        .option("header", "false")
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )
