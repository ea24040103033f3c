"""Merge a change set into a table: insert, update, delete by key.

Plain parquet has no ``MERGE INTO``, so the three branches are one outer join
on the key. Both sides hold a key at most once (reduce the change set with
``tidemark.operators.dedup`` first), so no key can be hot inside the join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import INSERT_ONLY_COLUMNS

ACTION = "_merge_action"
# The stored row that an update or a delete met, and whether an image of a row is taken from a table or added to it.
BEFORE, SIGN = "_before", "_sign"
POSITION = ("_cdc_source_ts", "_kafka_offset")
_OLD, _NEW = "old__", "new__"


class SchemaChangeError(ValueError):
    """Raised by the ``fail`` policy when the columns of two frames differ."""


def merged_columns(target: DataFrame, incoming: DataFrame, policy: str) -> list[str]:
    """Columns of the table after rows of ``incoming`` have entered it.

    * ``ignore``: the table's columns, new ones are dropped
    * ``append_new_columns``: the table's columns, then the new ones
    * ``sync_all_columns``: exactly the incoming columns
    * ``fail``: the table's columns; any difference is an error
    """
    have, new = target.columns, incoming.columns
    if policy == "ignore":
        return list(have)
    if policy == "append_new_columns":
        return have + [name for name in new if name not in have]
    if policy == "sync_all_columns":
        return list(new)
    if policy == "fail":
        if set(have) != set(new):
            raise SchemaChangeError(f"columns differ: {sorted(set(have) ^ set(new))}")
        return list(have)
    raise ValueError(f"unknown schema policy {policy!r}")


def evolve(df: DataFrame, like: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with exactly ``columns``; those it lacks are NULLs typed as in ``like``."""
    types = {field.name: field.dataType for field in like.schema}
    return df.select(
        *[F.col(name) if name in df.columns else F.lit(None).cast(types[name]).alias(name) for name in columns]
    )


def append_rows(target: DataFrame, incoming: DataFrame, policy: str = "append_new_columns") -> DataFrame:
    """Add rows to a table under a schema policy."""
    columns = merged_columns(target, incoming, policy)
    return evolve(target, incoming, columns).unionByName(evolve(incoming, target, columns))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(name).alias(prefix + name) for name in df.columns], F.lit(True).alias(prefix))


def _match(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    old, new = _prefixed(target, _OLD), _prefixed(changes, _NEW)
    return old.join(new, on=[old[_OLD + key] == new[_NEW + key] for key in keys], how="full_outer")


def _flag(prefix: str, name: str | None, columns: Sequence[str]) -> Column:
    if name is None or name not in columns:
        return F.lit(False)
    return F.coalesce(F.col(prefix + name), F.lit(False))


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    as_of: dt.datetime,
    keys: Sequence[str] = ("sale_id",),
    insert_only: Sequence[str] = tuple(INSERT_ONLY_COLUMNS),
    deleted: str | None = "is_deleted",
    policy: str = "ignore",
    before: bool = False,
) -> DataFrame:
    """Every row of either side with what happens to it in ``_merge_action``.

    ``keep`` (no change), ``update``, ``insert``, ``delete`` (shown as it was
    stored) and ``skip`` (a delete of a key that is not stored); ``merged``
    reduces this to the new table. An update takes all columns from the change
    except ``insert_only``; the audit stamps, where present, become ``as_of``.
    With ``before``, rows that are updated or deleted carry what was stored.
    """
    if deleted is not None and deleted not in target.columns:
        columns = merged_columns(target, changes.drop(deleted), policy)
    else:
        columns = merged_columns(target, changes, policy)
    stored, arrived = F.col(_OLD).isNotNull(), F.col(_NEW).isNotNull()
    is_delete = _flag(_NEW, deleted, changes.columns)
    action = (
        F.when(~arrived, "keep")
        .when(is_delete, F.when(stored, "delete").otherwise("skip"))
        .otherwise(F.when(stored, "update").otherwise("insert"))
    )
    matched = _match(target, changes, keys).withColumn(ACTION, action)

    now = F.lit(as_of).cast("timestamp_ntz")
    inserted, written = F.col(ACTION) == "insert", F.col(ACTION).isin("insert", "update")
    result = []
    for name in columns:
        old = F.col(_OLD + name) if name in target.columns else F.lit(None)
        new = F.col(_NEW + name) if name in changes.columns else old
        if name in keys:
            value = F.coalesce(old, new)
        elif name == "_row_inserted_at":
            value = F.when(inserted, now).otherwise(old)
        elif name == "_row_updated_at":
            value = F.when(written, now).otherwise(old)
        elif name in insert_only:
            value = F.when(inserted, new).otherwise(old)
        else:
            value = F.when(written, new).otherwise(old)
        result.append(value.alias(name))
    return matched.select(*result, ACTION, *_images(target, before))


def _images(target: DataFrame, wanted: bool) -> list[Column]:
    """What an update or a delete met, as a struct of the table's columns."""
    if not wanted:
        return []
    stored = F.struct(*[F.col(_OLD + name).alias(name) for name in target.columns])
    return [F.when(F.col(ACTION).isin("update", "delete"), stored).alias(BEFORE)]


def signed_images(actions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What a merge takes from a table (sign -1) and adds to it (sign 1), from actions that carry ``before``.

    Rows that stay as they are have no images. One pass, no shuffle.
    """
    after = F.when(F.col(ACTION).isin("insert", "update"), F.struct(*columns, F.lit(1).alias(SIGN)))
    before = F.when(F.col(BEFORE).isNotNull(), F.struct(*[F.col(BEFORE)[name].alias(name) for name in columns], F.lit(-1).alias(SIGN)))
    return actions.select(F.inline(F.filter(F.array(before, after), lambda image: image.isNotNull())))


def merged(actions: DataFrame) -> DataFrame:
    """The table after the merge."""
    return actions.filter(~F.col(ACTION).isin("delete", "skip")).drop(ACTION)


def merge_tally(actions: DataFrame) -> DataFrame:
    """How many rows each action took, as one row."""
    return actions.agg(
        *[
            F.count_if(F.col(ACTION) == action).alias(f"rows_{label}")
            for action, label in (("insert", "inserted"), ("update", "updated"), ("delete", "deleted"))
        ]
    )


def cdc_merge(target: DataFrame, changes: DataFrame, as_of: dt.datetime, **options) -> DataFrame:
    """``merge_changes`` followed by ``merged``."""
    return merged(merge_changes(target, changes, as_of, **options))


def upsert(
    target: DataFrame,
    delta: DataFrame,
    as_of: dt.datetime,
    keys: Sequence[str] = ("sale_id",),
    insert_only: Sequence[str] = tuple(INSERT_ONLY_COLUMNS),
    policy: str = "append_new_columns",
) -> DataFrame:
    """Insert or update, never delete."""
    return cdc_merge(target, delta, as_of, keys=keys, insert_only=insert_only, deleted=None, policy=policy)


def merge_newest(
    target: DataFrame,
    changes: DataFrame,
    as_of: dt.datetime,
    keys: Sequence[str] = ("sale_id",),
    insert_only: Sequence[str] = tuple(INSERT_ONLY_COLUMNS),
    deleted: str = "is_deleted",
    position: Sequence[str] = POSITION,
    before: bool = False,
) -> DataFrame:
    """Merge in which a change acts only if it is later than the stored row.

    The table must hold ``deleted`` and the ``position`` columns. Deleted keys
    stay in it as tombstones (``live_rows`` hides them): a key that left no
    trace could be revived by an older event arriving afterwards. A tombstone
    keeps the stored values, and with them its place in a partitioned table.

    Returns every row of the new table plus its ``_merge_action``; ``skip``
    marks tombstones of keys that were not live before.
    """
    stored, arrived = F.col(_OLD).isNotNull(), F.col(_NEW).isNotNull()
    was_live = stored & ~_flag(_OLD, deleted, target.columns)
    is_delete = _flag(_NEW, deleted, changes.columns)
    later = F.lit(False)
    for name in reversed(list(position)):
        old, new = F.col(_OLD + name), F.col(_NEW + name)
        later = F.when(old.isNull() & new.isNotNull(), True).when(new > old, True).when(new == old, later).otherwise(False)
    acts = arrived & (~stored | later)
    action = (
        F.when(~acts, "keep")
        .when(is_delete, F.when(was_live, "delete").otherwise("skip"))
        .otherwise(F.when(was_live, "update").otherwise("insert"))
    )
    matched = _match(target, changes, keys).withColumn(ACTION, action)

    now = F.lit(as_of).cast("timestamp_ntz")
    inserted, kept = F.col(ACTION) == "insert", F.col(ACTION) == "keep"
    buried = stored & F.col(ACTION).isin("delete", "skip")
    on_tombstone = {deleted, *position, "updated_at", "_cdc_operation"}
    result = []
    for name in target.columns:
        old = F.col(_OLD + name)
        new = F.col(_NEW + name) if name in changes.columns else old
        if name in keys:
            value = F.coalesce(old, new)
        elif name == "_row_inserted_at":
            value = F.when(inserted | ~stored, now).otherwise(old)
        elif name == "_row_updated_at":
            value = F.when(kept, old).otherwise(now)
        elif name in on_tombstone:
            value = F.when(kept, old).otherwise(new)
        elif name in insert_only:
            value = F.when(inserted | ~stored, new).otherwise(old)
        else:
            value = F.when(kept | buried, old).otherwise(new)
        result.append(value.alias(name))
    return matched.select(*result, ACTION, *_images(target, before))


def live_rows(table: DataFrame, deleted: str = "is_deleted") -> DataFrame:
    """A tombstone-keeping table without its tombstones."""
    return table.filter(~F.coalesce(F.col(deleted), F.lit(False)))


def delete_by_markers(target: DataFrame, markers: DataFrame, key: str = "sale_id") -> DataFrame:
    """Remove the rows whose key is among the markers."""
    gone = markers.filter(F.col(key).isNotNull()).select(key).distinct()
    return target.join(gone, on=key, how="left_anti")


def delete_insert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace all rows of the keys in ``delta`` by its rows."""
    kept = target.join(delta.select(*keys).distinct(), on=list(keys), how="left_anti")
    return kept.unionByName(delta, allowMissingColumns=True)


def rollback_batch(target: DataFrame, batch_id: str) -> DataFrame:
    """The table without the rows one batch loaded."""
    return target.filter(~F.col("etl_batch_id").eqNullSafe(F.lit(batch_id)))
