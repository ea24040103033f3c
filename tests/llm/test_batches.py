"""Texts reach Python in small Arrow batches, and workers bring no caches of other operators."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tests.conftest import SF_TINY
from tidemark.llm import arrays, language_id, near_dedup, packing
from tidemark.llm.common import BATCH_ROWS, text_batches

ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def longest(df):
    """Rows of the largest batch of each task, and rows in all."""
    run = lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches)
    found = [r.n for r in df.mapInPandas(run, "n long").collect()]
    return max(found), sum(found)


def test_batches_are_small_and_the_settings_come_back(spark):
    before = {k: spark.conf.get(k) for k in (ROWS, BYTES)}
    rows = 3 * BATCH_ROWS
    small = spark.range(0, rows, 1, 1).selectExpr("id", "'x' AS text")
    large = spark.range(0, 40, 1, 1).selectExpr("id", "repeat('x', 500000) AS text")
    with text_batches(spark):
        assert longest(small) == (BATCH_ROWS, rows)
        most, total = longest(large)
        assert most <= 8 and total == 40
    with pytest.raises(ValueError), text_batches(spark):
        raise ValueError
    assert {k: spark.conf.get(k) for k in before} == before
    spark.conf.set(ROWS, "7")
    try:
        with text_batches(spark):
            assert longest(small) == (7, rows)
        assert spark.conf.get(ROWS) == "7"
    finally:
        spark.conf.set(ROWS, before[ROWS])


def test_stages_with_texts_start_their_jobs_in_small_batches(spark, monkeypatch):
    seen = {}
    for module in (language_id, near_dedup, packing):
        def noted(df, purpose, *rest, write=module.written, **named):
            seen[purpose] = int(spark.conf.get(ROWS))
            return write(df, purpose, *rest, **named)

        monkeypatch.setattr(module, "written", noted)
    rng = random.Random(3)
    rows = [(k, " ".join("w%d" % rng.randrange(300) for _ in range(30)), "en", "s", 9) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.in_known_language, corpus_pipeline.without_near_copies, corpus_pipeline.in_sequences):
        stage(spark, docs, SF_TINY).count()
    assert {seen[name] for name in ("language-evidence", "near-sets", "pieces")} == {BATCH_ROWS}


def test_language_tasks_empty_caches_of_others():
    emptied = []
    arrays.hold("test", lambda: emptied.append(1))
    try:
        arrays.claim("one operator")
        arrays.claim("one operator")
        assert len(emptied) == 1
        arrays.hashes([b"left", b"over"])
        found, model = [], language_id.TextModel(["en", language_id.UNKNOWN], np.zeros((language_id.BUCKETS, 2), np.float32))

        class Rows:
            """Stands for a frame whose task runs here."""

            schema, sparkSession = [], type("S", (), {"sparkContext": type("C", (), {"broadcast": staticmethod(lambda x: type("B", (), {"value": x}))})})

            def withColumn(self, *_):
                return self

            def mapInPandas(self, run, _):
                found.extend(run(iter([pd.DataFrame({"doc_id": [1], "text": ["some words"]})])))

        language_id.with_likelihoods(Rows(), model, "text", markup=False)
        assert found[0]["grams"].tolist() == [8] and len(emptied) == 2 and not arrays._words
    finally:
        arrays._held.pop("test")
