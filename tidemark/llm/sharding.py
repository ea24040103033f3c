"""Shards as the leaves of a k-d tree over document metadata.

Equal texts form a unit. A node is split along its widest dimension (the range
it covers against the range of all rows) at the weighted median of bytes, until
every leaf is down to the target; a node that needs an odd number of leaves is
split at that share instead of the half. The medians are found by counting:
each pass adds up bytes by node and bin, picks the bin that holds the cut and
splits it again, so no task ever sees a node's rows together.

Units larger than a small share of a shard (of which there are few) are placed
first, the largest in the emptiest shard, and the tree fills the room that they
leave. A unit thus lies in one shard, unless there is none with room for it;
then its rows are dealt to parts that may be split. Null metadata sort first,
null texts have no bytes. Rows with equal ids are separate documents.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import running_total, salted_join, text_of, written

DIMENSIONS = ("n_points", "source_rank", "lang_rank")
BINS = 1024
# A unit above this share of a shard is placed before the tree; a cut this close to its aim is done.
UNIT_SHARE = 1 / 64
TOLERANCE = 1 / 1024
TIE_RANGE = 1 << 40


def measured(docs: DataFrame) -> DataFrame:
    """Size, checksum, unit and metadata of every row of a table with doc_id, text, source and lang."""
    text = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("unit"),
        F.length(text).cast("long").alias("n_points"),
        "source",
        "lang",
        F.monotonically_increasing_id().alias("row"),
    )


def _ranks(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column and their ranks by code point; one row per value."""
    values = rows.select(column).distinct()
    return values.select(column, F.row_number().over(Window.orderBy(F.col(column).asc_nulls_first())).cast("long").alias(f"{column}_rank"))


def large_units(rows: DataFrame, target: float, shards: int) -> DataFrame:
    """Units above ``UNIT_SHARE`` of a shard with the shard that takes them whole, null where none has room.

    No more than ``shards / UNIT_SHARE`` units are so large; one task places
    them by their bytes alone.
    """

    def place(units: pd.DataFrame) -> pd.DataFrame:
        emptiest = [(0, k) for k in range(shards)]
        units = units.sort_values(["bytes", "unit"], ascending=[False, True])
        found: list[int | None] = []
        for size in units["bytes"].tolist():
            load, shard = emptiest[0]
            fits = load + size <= target * (1 + TOLERANCE)
            if fits:
                heapq.heapreplace(emptiest, (load + size, shard))
            found.append(shard if fits else None)
        return units.assign(shard=pd.array(found, dtype="Int64"))

    weights = rows.groupBy("unit").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > target * UNIT_SHARE)
    return written(weights.groupBy(F.lit("all")).applyInPandas(place, "unit long, bytes long, shard long"), "kd-large")


def rooms(large: DataFrame, target: float, shards: int) -> DataFrame:
    """The bytes left in all shards before each, as ``upto``: one row per shard and one for the end."""
    loads = large.filter("shard is not null").groupBy("shard").agg(F.sum("bytes").alias("_load"))
    every = large.sparkSession.range(shards + 1).select(F.col("id").alias("shard"))
    room = F.greatest(F.lit(0.0), F.lit(float(target)) - F.coalesce("_load", F.lit(0)))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum(room).over(before), F.lit(0.0)).alias("upto")
    return written(every.join(loads, "shard", "left").select("shard", upto), "kd-rooms")


def units_of(rows: DataFrame, large: DataFrame, target: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their unit's part or its shard, and one row per part without one: bytes and metadata of its first document."""
    parts = F.when(F.col("shard").isNull(), F.ceil(F.col("bytes") / max(1.0, target * UNIT_SHARE)).cast("int"))
    heavy = large.select("unit", parts.alias("_parts"), F.col("shard").alias("_shard"))
    dealt = salted_join(rows, heavy, ["unit"], F.col("row"), "left", grows=True).withColumn(
        "part", F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("row"), F.col("_parts"))).cast("int")
    )
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), "row", "n_points", "source", "lang"))
    units = dealt.filter("_shard is null").groupBy("unit", "part").agg(F.sum("size").alias("bytes"), first.alias("_first"))
    return dealt, units.select("unit", "part", "bytes", "_first.n_points", "_first.source", "_first.lang")


def kd_leaves(units: DataFrame, leaves: int, room: DataFrame | None = None) -> DataFrame:
    """``units`` with column ``leaf``, from 0 on; leaves fill in proportion to their ``room``, equal unless given."""
    if room is None:
        room = units.sparkSession.range(leaves + 1).select(F.col("id").alias("shard"), F.col("id").cast("double").alias("upto"))
    bounds = units.agg(*[F.greatest(F.max(d) - F.min(d) + 1, F.lit(1)).alias(d) for d in DIMENSIONS]).first()
    ranges = {d: bounds[d] or 1 for d in DIMENSIONS}
    now = units.withColumn("leaf", F.lit(0).cast("long")).withColumn("leaves", F.lit(leaves).cast("long")).withColumn(
        "tie", F.pmod(F.xxhash64("unit", "part"), F.lit(TIE_RANGE))
    )
    for _ in range(max(0, math.ceil(math.log2(max(1, leaves))))):
        wide = F.greatest(*[F.struct(((F.max(d) - F.min(d) + 1) / ranges[d]).alias("width"), F.lit(-i).alias("no"), F.min(d).alias("low"), F.max(d).alias("high")) for i, d in enumerate(DIMENSIONS)])
        nodes = now.filter("leaves > 1").groupBy("leaf", "leaves").agg(wide.alias("_w"), F.sum("bytes").alias("_all"))
        half = F.floor(F.col("leaves") / 2)
        for name, place in (("_from", F.col("leaf")), ("_mid", F.col("leaf") + half), ("_to", F.col("leaf") + F.col("leaves"))):
            at = room.select(F.col("shard").alias("_place"), F.col("upto").alias(name))
            nodes = nodes.join(at, place == F.col("_place")).drop("_place")
        share = F.coalesce(F.try_divide(F.col("_mid") - F.col("_from"), F.col("_to") - F.col("_from")), F.lit(0.0))
        nodes = nodes.select(
            "leaf",
            (-F.col("_w.no")).alias("dim"),
            # The key in a node: its value in the widest dimension, ties in a fixed random order.
            F.lit(0).cast("decimal(38,0)").alias("low"),
            ((F.col("_w.high") - F.col("_w.low") + 1).cast("decimal(38,0)") * TIE_RANGE).alias("high"),
            F.col("_w.low").alias("origin"),
            (F.col("_all") * share).alias("aim"),
            (F.col("_all") * TOLERANCE / F.col("leaves")).alias("slack"),
        )
        nodes = written(nodes, "kd-nodes")
        value = F.element_at(F.array(*[F.col(d) for d in DIMENSIONS]), F.col("dim") + 1)
        keyed = written(
            _joined(now, nodes.select("leaf", "dim", "origin"))
            .withColumn("key", (value - F.col("origin")).cast("decimal(38,0)") * TIE_RANGE + F.col("tie"))
            .drop("dim", "origin"),
            "kd-keys",
        )
        cut = _cuts(keyed.filter("leaves > 1"), nodes)
        lower = F.coalesce(F.col("key") < F.col("cut"), F.lit(True))
        split = F.col("leaves") > 1
        now = written(
            _joined(keyed, cut).select(
                *units.columns,
                "tie",
                F.when(split & ~lower, F.col("leaf") + half).otherwise(F.col("leaf")).cast("long").alias("leaf"),
                F.when(split & lower, half).when(split, F.col("leaves") - half).otherwise(F.col("leaves")).cast("long").alias("leaves"),
            ),
            "kd-units",
        )
    return now.drop("leaves", "tie")


def _joined(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """Units with what their node has; a node holds many units, so nodes are salted."""
    return salted_join(units, nodes, ["leaf"], F.col("tie"), "left")


def _cuts(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """The key at which each node is cut: the least with enough bytes below it."""
    state = nodes.select("leaf", "low", "high", "aim", "slack").withColumn("below", F.lit(0).cast("double"))
    while True:
        width = F.greatest(F.ceil((F.col("high") - F.col("low")) / BINS), F.lit(1)).cast("decimal(38,0)")
        inside = _joined(units.select("leaf", "tie", "key", "bytes"), state.select("leaf", "low", "high")).filter(
            (F.col("key") >= F.col("low")) & (F.col("key") < F.col("high"))
        )
        bins = inside.groupBy("leaf", F.floor((F.col("key") - F.col("low")) / width).cast("long").alias("bin")).agg(
            F.sum("bytes").cast("double").alias("bytes")
        )
        upto = F.sum("bytes").over(Window.partitionBy("leaf").orderBy("bin"))
        reached = (
            bins.withColumn("upto", upto)
            .join(state, "leaf")
            .filter(F.col("below") + F.col("upto") >= F.col("aim"))
            .groupBy("leaf")
            .agg(F.min(F.struct("bin", "bytes", "upto", "low", "high", "aim", "slack", "below")).alias("s"))
            .select("leaf", "s.*")
            .withColumn("width", F.greatest(F.ceil((F.col("high") - F.col("low")) / BINS), F.lit(1)).cast("decimal(38,0)"))
        )
        first = F.col("low") + F.col("bin") * F.col("width")
        state = written(
            reached.select(
                "leaf",
                first.cast("decimal(38,0)").alias("low"),
                F.least(F.col("high"), first + F.col("width")).cast("decimal(38,0)").alias("high"),
                "aim",
                "slack",
                (F.col("below") + F.col("upto") - F.col("bytes")).alias("below"),
                "bytes",
            ),
            "kd-cuts",
        )
        if not state.filter((F.col("bytes") > F.col("slack")) & (F.col("high") - F.col("low") > 1)).limit(1).count():
            break
        state = state.drop("bytes")
    # The side of the last bin on which the cut is nearer to its aim.
    nearer = F.col("aim") - F.col("below") > F.col("bytes") / 2
    return state.select("leaf", F.when(nearer, F.col("high")).otherwise(F.col("low")).alias("cut"))


def kd_shards(docs: DataFrame, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """Every document with its shard, by target bytes of a leaf or by their number, and a gapless slot in it."""
    rows = written(measured(docs), "kd-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    leaves = shards if shards is not None else max(1, math.ceil(total / max(1, target_bytes)))
    target = max(1.0, total / leaves)
    large = large_units(rows, target, leaves)
    dealt, units = units_of(rows, large, target)
    ranked = units
    for column in ("source", "lang"):
        ranks = _ranks(units, column).withColumnRenamed(column, "_value")
        key = ranks.select(F.coalesce("_value", F.lit("")).alias("_key"), F.col("_value").isNull().alias("_none"), f"{column}_rank")
        ranked = salted_join(
            ranked.withColumn("_key", F.coalesce(column, F.lit(""))).withColumn("_none", F.col(column).isNull()), key, ["_key", "_none"], F.col("unit")
        ).drop("_key", "_none")
    placed = kd_leaves(written(ranked.drop("source", "lang"), "kd-start"), leaves, rooms(large, target, leaves))
    whole = dealt.filter("_shard is not null").withColumn("shard", F.col("_shard"))
    in_tree = dealt.filter("_shard is null").join(placed.select("unit", "part", F.col("leaf").alias("shard")), ["unit", "part"])
    sharded = written(whole.unionByName(in_tree), "kd-sharded").withColumn("_one", F.lit(1).cast("long"))
    numbered = running_total(sharded, ["shard", "doc_id", "row"], "_one", "_at", "kd-slots")
    first = numbered.groupBy("shard").agg(F.min("_at").alias("_first"))
    return salted_join(numbered, first, ["shard"], F.col("row")).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("_at") - F.col("_first")).cast("long").alias("slot")
    )
