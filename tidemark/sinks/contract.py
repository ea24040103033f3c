"""Writes that enforce a table's contract.

Conditions are part of the write's own plan: every row is judged by the task
that writes it, and the first breach fails the job. Rows go into a folder of
their own first and replace the table only when all have passed, so a breach
leaves the table as it was. No second pass over the input is made.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.quality import contract_breaches
from tidemark.session import written
from tidemark.sinks import partitions


class ContractError(ValueError):
    """Columns of a frame differ from its contract in name or type."""


def enforced(df: DataFrame, contract: StructType, conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` in the contract's columns; a row that breaks it stops the job that reads it.

    Names and types are compared at once, without a job. Required columns must
    have a value and ``conditions`` must not be false; NULL passes a condition.
    """
    breaches = contract_breaches(df, contract)
    if breaches:
        raise ContractError("; ".join(breaches))
    rules = {f"{field.name} is missing": F.col(field.name).isNotNull() for field in contract if not field.nullable}
    rules |= {name: F.coalesce(condition, F.lit(True)) for name, condition in (conditions or {}).items()}
    judged = df.select(*contract.names)
    for name, holds in rules.items():
        # assert_true gives NULL for a row that passes, so the filter keeps exactly these rows.
        judged = judged.filter(F.assert_true(holds, F.lit(f"contract broken: {name}")).isNull())
    return judged


def rebuild(df: DataFrame, path: str, contract: StructType, conditions: Mapping[str, Column] | None = None) -> None:
    """Replace a table by rows that all keep its contract."""
    partitions.rebuild(written(enforced(df, contract, conditions), "contract"), path)


def replace_slices(
    df: DataFrame, path: str, by: Sequence[str], contract: StructType, conditions: Mapping[str, Column] | None = None
) -> None:
    """Replace slices of a partitioned table by rows that all keep its contract."""
    partitions.replace_slices(written(enforced(df, contract, conditions), "contract"), path, by)
