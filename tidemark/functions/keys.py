"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import SURROGATE_NULL


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the columns as text, NULLs standing as a fixed token."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL))
        for c in columns
    ]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("-", *parts))


def version_key(key: Column | str, updated_at: Column | str) -> Column:
    """Identity of one version of a record: md5 of ``key|updated_at``."""
    key = F.col(key) if isinstance(key, str) else key
    updated_at = F.col(updated_at) if isinstance(updated_at, str) else updated_at
    stamp = F.date_format(updated_at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", key.cast("string"), stamp))
