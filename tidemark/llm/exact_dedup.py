"""Exact duplicates by counting quotient filters.

The fingerprint of a text's bytes, white space deleted, is split into a
quotient and a remainder. Every partition builds a counting quotient filter of
its fingerprints; filters of one range of quotients are merged by their sorted
remainders, counts added, without loss. Documents whose fingerprint counts more
than one go on to verification, where texts are grouped by their bytes; equal
bytes meet in a pre-aggregated group, so a text with a third of all rows leaves
each task as one row.

Null texts count as empty, so all empty texts are one group. Rows with equal
ids are separate documents; of equal rows one stays. A null id loses to others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import salted_join, text_of, without_rows, without_space, written

# Quotients in one range; a range's filters meet in one task.
RANGE_BITS = 15
FILTER = "range int, runs binary, remainders binary, counts binary"


def quotient_bits(rows: int) -> int:
    """As many quotients as rows, so that a run holds about one remainder."""
    return max(RANGE_BITS, math.ceil(math.log2(max(2, rows))))


def build_filters(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Counting quotient filters of sorted, distinct fingerprints, one for each range of quotients.

    A filter holds the length of each quotient's run, the runs' remainders in
    order, and their counts.
    """
    rest = np.uint64(64 - bits)
    quotients = fingerprints >> rest
    remainders = fingerprints & ((np.uint64(1) << rest) - np.uint64(1))
    ranges = (quotients >> np.uint64(RANGE_BITS)).astype(np.int64)
    for begin, end in zip(*_runs(ranges), strict=True):
        slots = (quotients[begin:end] & np.uint64((1 << RANGE_BITS) - 1)).astype(np.int64)
        runs = np.bincount(slots, minlength=1 << RANGE_BITS).astype(np.uint32)
        yield int(ranges[begin]), runs.tobytes(), remainders[begin:end].tobytes(), counts[begin:end].tobytes()


def read_filter(number: int, runs: bytes, remainders: bytes, counts: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a filter, sorted, and their counts."""
    slots = np.repeat(np.arange(1 << RANGE_BITS, dtype=np.uint64), np.frombuffer(runs, np.uint32))
    quotients = (np.uint64(number) << np.uint64(RANGE_BITS)) | slots
    return (quotients << np.uint64(64 - bits)) | np.frombuffer(remainders, np.uint64), np.frombuffer(counts, np.int64)


def merge_counts(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints with their counts added."""
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    begin, _ = _runs(fingerprints)
    return fingerprints[begin], np.add.reduceat(counts, begin) if len(begin) else counts


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return begin, np.r_[begin[1:], len(values)]


def repeated_fingerprints(fingerprints: DataFrame, bits: int) -> DataFrame:
    """The values of column ``fp`` that occur more than once, with how often."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64).view(np.uint64)
            merged = merge_counts(values, np.ones(len(values), np.int64))
            yield pd.DataFrame(list(build_filters(*merged, bits)), columns=["range", "runs", "remainders", "counts"])

    def merge(filters: pd.DataFrame) -> pd.DataFrame:
        read = [read_filter(*row, bits) for row in filters.itertuples(index=False)]
        values, counts = merge_counts(np.concatenate([r[0] for r in read]), np.concatenate([r[1] for r in read]))
        many = counts > 1
        return pd.DataFrame({"fp": values[many].view(np.int64), "copies": counts[many]})

    return (
        fingerprints.select("fp")
        .mapInPandas(build, FILTER)
        .groupBy("range")
        .applyInPandas(merge, "fp long, copies long")
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """Every row of a table with doc_id and text, with the row of its group that stays."""
    text = text_of()
    plain = without_space(text)
    prints = written(
        docs.select(
            "doc_id",
            F.xxhash64(plain).alias("fp"),
            F.sha2(plain, 256).alias("text_sha256"),
            F.length(text).cast("long").alias("n_points"),
            F.xxhash64("text").alias("text_hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-prints",
    )
    rows = prints.count()
    bits = quotient_bits(rows)
    repeats = written(repeated_fingerprints(prints, bits), "exact-repeats", rows)
    routed = prints.join(repeats, "fp", "left_semi")
    # A stored list of ids, so that Spark knows its size before it joins the texts.
    ids = written(routed.select("doc_id").distinct(), "exact-routed", rows)
    bytes_equal = (
        docs.select("doc_id", "text")
        .join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
        .select(without_space(text_of()).alias("plain"))
        .groupBy(F.xxhash64("plain").alias("fp"), F.sha2("plain", 256).alias("text_sha256"), "plain")
        .agg(F.count("*").alias("_rows"))
        .groupBy("fp", "text_sha256")
        .agg(F.count("*").alias("texts"), F.sum("_rows").alias("_rows"))
    )
    longest = F.max(F.struct("n_points", F.coalesce(-F.col("doc_id"), F.lit(-(2**63))).alias("last"), (-F.col("row")).alias("row"), "doc_id"))
    groups = (
        routed.groupBy("fp", "text_sha256")
        .agg(longest.alias("best"), F.count("*").alias("group_size"))
        .join(bytes_equal, ["fp", "text_sha256"])
        .filter(F.when(F.col("texts") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("different bytes under one digest")).cast("boolean")))
        .select("fp", "text_sha256", F.col("best.doc_id").alias("_keep"), (-F.col("best.row")).alias("_row"), "group_size")
    )
    joined = salted_join(prints, groups, ["fp", "text_sha256"], F.col("row"), "left", grows=True)
    alone = F.col("_row").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("_row"))).alias("kept"),
        "text_sha256",
        "text_hash",
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns. Texts move only for rows that go or repeat."""
    return without_rows(docs, written(exact_groups(docs), "exact-groups", docs.count()), "not kept")
