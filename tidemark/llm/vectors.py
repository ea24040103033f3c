"""Vectors as whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def whole_vectors(vectors: DataFrame, column: str, others: list, scale: int, shift: int, largest: float, purpose: str) -> DataFrame:
    """``others`` and ``x``: floor(scale * component) + shift for every component, stored.

    Rows are left out whose vector is null, empty or holds a null, a value that
    is not finite or one of ``largest`` and more, and those of another length
    than most vectors have (of equally frequent lengths the shortest stays).
    """
    value = F.col(column)
    fits = value.isNotNull() & (F.size(value) > 0) & F.forall(value, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float(largest)), F.lit(False)))
    # In Spark NaN is larger than any number, so the comparison leaves it out.
    whole = F.transform(value, lambda c: F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(shift))
    stored = written(vectors.filter(fits).select(*others, whole.alias("x"), F.size(value).alias("dimension")), purpose)
    most = stored.groupBy("dimension").count().orderBy(F.desc("count"), "dimension").first()
    return stored.filter(F.col("dimension") == (most["dimension"] if most else 0)).drop("dimension")
