"""Substring dedup where ids repeat and hashes collide."""

from __future__ import annotations

from tidemark.llm import substring_dedup


def row(result):
    return sorted((r.doc_id, r.n_words, r.n_removed) for r in result.collect())


def test_texts_of_one_id_are_told_apart(spark):
    import xxhash

    passage = " ".join("p%d" % k for k in range(40))
    long = " ".join("t%d" % k for k in range(30)) + " " + passage + " end"
    low = xxhash.xxh3_64_intdigest(long.encode()) & 0xFFFF
    short = next(s for s in (f"u{k}" for k in range(1_000_000)) if xxhash.xxh3_64_intdigest(s.encode()) & 0xFFFF == low)
    other = next(s for s in ("x " * 60 + f"v{k}" for k in range(1_000_000)) if xxhash.xxh3_64_intdigest(s.encode()) & 0xFFFF == low)
    for twin in (short, other):
        docs = spark.createDataFrame([(0, passage), (5, long), (5, twin)], "doc_id long, text string")
        want = sorted([(0, 40, 0), (5, 71, 40), (5, len(twin.split()), 0)])
        assert row(substring_dedup.without_repeats(docs)) == want


def test_colliding_hashes_remove_only_what_repeats(spark):
    passage = " ".join("p%d" % k for k in range(60))
    docs = [(k, " ".join(f"d{k}w{j}" for j in range(80))) for k in range(12)] + [(50, passage), (60, "head " + passage)]
    found = row(substring_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"), hash_bits=10))
    exact = dict((i, r) for i, _, r in row(substring_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert exact[60] == 60 and sum(exact.values()) == 60
    assert all(removed <= exact[i] for i, _, removed in found)
