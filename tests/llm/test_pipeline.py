"""The stages of the corpus pipeline and the whole of it, with awkward rows."""

from __future__ import annotations

import collections
import random

import pytest

import corpus_pipeline
from tests.conftest import SF_TINY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def prose(seed, words=60):
    rng = random.Random(seed)
    return " ".join("w%d" % rng.randrange(5000) for _ in range(words))


def more(text):
    return text + " and more"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t, lang, source in rows], SCHEMA).repartition(3)


def kept(df):
    return collections.Counter((r.doc_id, r.text, r.lang, r.source) for r in df.collect())


def test_near_copies_go_by_row(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(1, a, "en", "s"), (5, more(a), "en", "s"), (5, b, "en", "s"), (9, c, "en", "s"), (9, c, "en", "s"), (None, more(c), "en", "s")]
    rows += [(None, prose(4), "en", "s"), (None, None, None, None), (7, "", None, None), (8, "short", None, "s"), (-3, more(b), None, "s")]
    docs = table(spark, rows)
    out = STAGES["ngram_jaccard_join"](spark, docs, SF_TINY)
    assert out.columns == docs.columns
    want = [rows[0], rows[3], rows[6], rows[7], rows[8], rows[9], rows[10]]
    assert kept(out) == collections.Counter(want)
    assert STAGES["ngram_jaccard_join"](spark, docs.limit(0), SF_TINY).count() == 0


def test_language_stage_keeps_short_texts_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(150)
    rows = [(9001, "ok", "en", "good"), (9002, None, "en", "good"), (9003, " \n", "en", "good"), (9004, "same words here", "en", "a")]
    rows += [(9004, "same words here", "de", "b"), (9004, "same words here", "de", "b")]
    out = STAGES["language_id"](spark, docs.unionByName(table(spark, rows)), SF_TINY)
    assert out.columns == docs.columns
    got = collections.Counter((r.doc_id, r.lang) for r in out.filter("doc_id > 9000").collect())
    assert got == {(9001, "en"): 1, (9004, "en"): 1, (9004, "de"): 2}


def test_whole_run(spark):
    """Every id of the result comes from the documents, and texts that stood alone are all there."""
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_TINY)
    got = collections.Counter(r.doc_id for r in out.collect())
    texts = {r.doc_id: "".join((r.text or "").split()) for r in docs.collect()}
    assert set(got) <= set(texts)
    firsts = {}
    for doc_id in sorted(texts):
        firsts.setdefault(texts[doc_id], doc_id)
    alone = collections.Counter(texts.values())
    assert not [i for i in got if alone[texts[i]] > 1 and sum(texts[j] == texts[i] for j in got) > 1]
    assert len(got) > len(firsts) / 2


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES if n != "language_id"])
def test_stages_of_an_empty_table(spark, name):
    assert STAGES[name](spark, table(spark, [(1, "a b", "en", "s")]).limit(0), SF_TINY).count() == 0
