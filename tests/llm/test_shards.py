"""Shards: equal texts, balance, and the tree against a walk over all rows."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string"


def table(spark, groups, singles, seed=1):
    """Groups of (copies, length of the text) among single texts."""
    rng = random.Random(seed)
    texts = ["%030x" % rng.getrandbits(120) * (length // 30) for _, length in groups]
    rows = [t for t, (copies, _) in zip(texts, groups, strict=True) for _ in range(copies)]
    rows += ["%030x" % rng.getrandbits(120) * rng.randint(1, 9) for _ in range(singles)]
    rng.shuffle(rows)
    made = [(i, t, rng.choice(["en", "fr", None]), f"s{rng.randrange(5)}") for i, t in enumerate(rows)]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def by_shard(docs, shards):
    return docs.join(sharding.kd_shards(docs, shards=shards), "doc_id").collect()


@pytest.mark.parametrize("groups", [[(60, 120)], [(60, 120), (40, 300), (9, 900), (30, 30)], [(140, 90), (20, 600)]])
def test_equal_texts_lie_together(spark, groups):
    got = by_shard(table(spark, groups, 600), 8)
    sizes, places = collections.Counter(), collections.defaultdict(set)
    for r in got:
        sizes[r.shard] += r["size"]
        places[r.text].add(r.shard)
    assert sorted(sizes) == list(range(8))
    assert max(sizes.values()) - min(sizes.values()) < 0.06 * sum(sizes.values()) / 8
    assert all(len(found) == 1 for found in places.values())


def test_a_group_larger_than_a_shard_is_dealt(spark):
    docs = table(spark, [(400, 300), (30, 300)], 500)
    got = by_shard(docs, 8)
    assert len(got) == 930
    sizes, places = collections.Counter(), collections.defaultdict(set)
    for r in got:
        sizes[r.shard] += r["size"]
        places[r.text].add(r.shard)
    assert max(sizes.values()) < 1.05 * sum(sizes.values()) / 8
    assert sum(len(found) > 1 for found in places.values()) == 1


@pytest.mark.parametrize("room", [[1, 1, 1, 1, 1], [1, 3, 0, 2, 2]])
def test_tree_splits_the_widest_dimension_at_the_aim(spark, room):
    rng = random.Random(7)
    rows = [(k, 0, rng.randint(1, 50), rng.randrange(10**4), rng.randrange(9), rng.randrange(4)) for k in range(2000)]
    units = spark.createDataFrame(rows, "unit long, part int, bytes long, n_points long, source_rank long, lang_rank long")
    upto = [sum(room[:k]) for k in range(len(room) + 1)]
    rooms = spark.createDataFrame([(k, float(v)) for k, v in enumerate(upto)], "shard long, upto double")
    got = sharding.kd_leaves(units, len(room), rooms).collect()
    assert sorted(r.unit for r in got) == list(range(2000))
    spans = {d: max(r[d] for r in got) - min(r[d] for r in got) + 1 for d in sharding.DIMENSIONS}

    def check(node, leaf, leaves):
        if leaves == 1 or not node:
            return
        half = leaves // 2
        lower, upper = [r for r in node if r.leaf < leaf + half], [r for r in node if r.leaf >= leaf + half]
        wide = {d: (max(r[d] for r in node) - min(r[d] for r in node) + 1) / spans[d] for d in sharding.DIMENSIONS}
        cut = max(sharding.DIMENSIONS, key=lambda d: wide[d])
        if lower and upper:
            assert max(r[cut] for r in lower) <= min(r[cut] for r in upper)
        total = upto[leaf + leaves] - upto[leaf]
        aim = sum(r.bytes for r in node) * ((upto[leaf + half] - upto[leaf]) / total if total else 0)
        assert abs(sum(r.bytes for r in lower) - aim) <= 50 + aim / 100
        check(lower, leaf, half)
        check(upper, leaf + half, leaves - half)

    check(got, 0, len(room))


def test_equal_ids_and_clashing_columns(spark):
    docs = table(spark, [(5, 60)], 40).withColumn("doc_id", F.col("doc_id") % 7)
    for name in ("size", "unit", "part", "shard", "row", "bytes"):
        docs = docs.withColumn(name, F.lit("x"))
    got = sharding.kd_shards(docs, shards=3).collect()
    assert len(got) == 45
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
