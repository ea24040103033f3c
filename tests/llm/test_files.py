"""Small stored tables go into few files, however many partitions a shuffle has."""

from __future__ import annotations

import random
from pathlib import Path
from urllib.parse import urlparse

import pytest

import corpus_pipeline
from tests.conftest import SF_TINY
from tidemark.llm import graph, mixing
from tidemark.session import shared_dir, written

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 24 partitions that stay 24."""
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def stored(spark):
    """The number of files of each stored table."""
    root = Path(urlparse(shared_dir(spark)).path) / "tidemark"
    return {p.name: len(list(p.glob("part-*"))) for p in root.iterdir()} if root.exists() else {}


def files_of(spark, action):
    before = stored(spark)
    out = action()
    return out, {name: n for name, n in stored(spark).items() if name not in before}


def prose(seed, words=40):
    rng = random.Random(seed)
    return " ".join("w%d" % rng.randrange(4000) for _ in range(words))


def test_rows_bound_the_files(spark, many_partitions):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(1000).repartition(24, "id")
    kept, files = files_of(spark, lambda: written(df, "bounded", 1000))
    assert list(files.values()) == [cores] and sorted(r.id for r in kept.collect()) == list(range(1000))
    _, files = files_of(spark, lambda: written(df, "more", 1000, 1000 // (cores + 2)))
    assert cores < list(files.values())[0] <= cores + 3
    _, files = files_of(spark, lambda: written(df, "free"))
    assert list(files.values()) == [24]


def test_rounds_of_components_go_into_few_files(spark, many_partitions):
    edges = spark.createDataFrame([(k, k + 1) for k in range(400) if k % 100 != 99], "a long, b long")
    found, files = files_of(spark, lambda: {r.node: r.component for r in graph.components(edges, 400).collect()})
    assert found == {k: k // 100 * 100 for k in range(400)}
    assert len(files) > 2 and max(files.values()) <= spark.sparkContext.defaultParallelism


def test_stages_store_few_files(spark, many_partitions):
    rows = [(k, prose(k // 3) + " x" * (k % 3), "en", "s%d" % (k % 5), 9) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    near = lambda: {r.doc_id for r in STAGES["ngram_jaccard_join"](spark, docs, SF_TINY).collect()}
    kept, files = files_of(spark, near)
    assert kept == {k for k in range(240) if k % 3 == 0}
    exact, others = files_of(spark, lambda: STAGES["exact_dedup"](spark, docs, SF_TINY).count())
    assert exact == 240
    _, mixed = files_of(spark, lambda: mixing.mix(docs))
    cores = spark.sparkContext.defaultParallelism
    assert not {name: n for name, n in {**files, **others, **mixed}.items() if n > cores}
