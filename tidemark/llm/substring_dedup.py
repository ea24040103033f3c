"""Repeated passages by compaction of the graph of word k-mers.

Every window of ``words`` consecutive words is an edge of a De Bruijn graph.

1. *Edges.* Windows are dealt to parts by their minimizer (the least hash of the
   shorter runs of words inside them), so neighbouring windows mostly go
   together and travel as runs. A chunk of documents sends each distinct window
   once, from the smallest id; the others are repeats already. A part finds the
   edges that occur under several ids, and where each occurs first: the edge's
   source coordinates.
2. *Paths.* Where consecutive windows of a document follow consecutive source
   coordinates, the path through the graph does not branch. Such fragments are
   joined end to start into paths.
3. *Spans.* A path is a span of words with its source. The words of span and
   source are compared by a digest of their own, as a 64-bit hash cannot vouch
   for them. A span that differs from its source is taken apart into windows,
   and those that differ are dropped: they only share a hash. (Whether such a
   window has yet another source is not asked, so it stays in.)
4. *Removal.* Words of a document under its spans are removed.

A window counts as repeated only if a document with a smaller id has it, all
judged on the input. A null text has no words. Rows with equal ids are judged
apart and do not count as each other's source; rows with a null id keep all
their words and are nobody's source.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import CHUNK_BYTES, carrier, document_chunks, hashes, mixed, packed, record_batch, runs, sequences, texts, unpacked
from tidemark.llm.common import text_of, written

WORDS = 13
MINIMIZER_WORDS = 7
PART_BYTES = 13_000_000
SLICES = "part long, keys binary, lengths binary, starts binary, ids binary, tags binary, counts binary, fragments binary"
FRAGMENT = "doc_id long, tag long, start long, length long, source_id long, source_tag long, source_start long"
FIELDS = [c.split()[0] for c in FRAGMENT.split(", ")]


def tag_of(text: bytes) -> int:
    """Tells texts of one id apart: 63 bits of a hash, as a long of nought or more."""
    return xxhash.xxh3_64_intdigest(text) >> 1


def fragments(ids: np.ndarray, tags: np.ndarray, pos: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Windows in document order, each with its source's row (id, tag, position), joined where both run on."""
    if not len(ids):
        return np.zeros((0, len(FIELDS)), np.int64)
    on = (
        (ids[1:] == ids[:-1]) & (tags[1:] == tags[:-1]) & (pos[1:] == pos[:-1] + 1)
        & (source[1:, 0] == source[:-1, 0]) & (source[1:, 1] == source[:-1, 1]) & (source[1:, 2] == source[:-1, 2] + 1)
    )
    begin = np.flatnonzero(np.r_[True, ~on])
    length = np.diff(np.r_[begin, len(ids)])
    return np.column_stack([ids[begin], tags[begin], pos[begin], length, source[begin]])


def repeated_fragments(docs: DataFrame, words: int = WORDS, minimizer_words: int = MINIMIZER_WORDS, hash_bits: int = 64) -> DataFrame:
    """Fragments of documents whose windows a smaller id has, with their source coordinates."""
    dropped = np.uint64(64 - hash_bits)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, math.ceil(math.log2(max(1, size / PART_BYTES))))
    parts = 1 << bits

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in document_chunks(batches):
            split = [text.split() for _, text in chunk]
            counts = np.array([len(s) for s in split])
            ids = np.array([d[0] for d in chunk], np.int64)
            tags = np.array([tag_of(text) for _, text in chunk], np.int64)
            word = hashes([w for s in split for w in s])
            doc = np.repeat(np.arange(len(chunk)), counts)
            begins = np.cumsum(counts) - counts
            windows = sequences(word, words)
            at = np.flatnonzero(doc[: len(windows)] == doc[words - 1 :]) if len(windows) else np.zeros(0, np.int64)
            doc, pos = doc[at], at - begins[doc[at]]
            keys = windows[at] >> dropped
            inner = sequences(word, minimizer_words)
            least = inner[: len(windows)].copy() if len(windows) else inner[:0]
            for k in range(1, words - minimizer_words + 1):
                np.minimum(least, inner[k : k + len(windows)], out=least)
            part = (mixed(least[at]) >> np.uint64(64 - bits)).astype(np.int64)
            # Of equal windows the first has the smallest id; those of larger ids are repeats.
            order = np.argsort(keys, kind="stable")
            begin, length = runs(keys[order])
            first = np.empty(len(keys), np.int64)
            first[order] = np.repeat(order[begin], length)
            local = np.flatnonzero(ids[doc] != ids[doc[first]])
            source = first[local]
            here = fragments(
                ids[doc[local]], tags[doc[local]], pos[local], np.column_stack([ids[doc[source]], tags[doc[source]], pos[source]])
            )
            sent = np.flatnonzero(ids[doc] == ids[doc[first]])
            sent = sent[np.argsort(part[sent], kind="stable")]
            ends = np.searchsorted(part[sent], np.arange(parts + 1))
            rows, carried = [], carrier(number, bits)
            for p in range(parts):
                s = sent[ends[p] : ends[p + 1]]
                if not len(s) and p != carried:
                    continue
                run = np.flatnonzero(np.r_[True, (np.diff(s) != 1) | (np.diff(doc[s]) != 0)]) if len(s) else s
                of, per = runs(doc[s[run]])
                owner = doc[s[run]][of]
                rows.append(
                    (
                        p,
                        keys[s].tobytes(),
                        packed(np.diff(np.r_[run, len(s)])),
                        packed(pos[s[run]]),
                        ids[owner].tobytes() if not len(owner) else ids[owner[:1]].tobytes() + packed(np.diff(ids[owner])),
                        packed(tags[owner]),
                        packed(per),
                        here.tobytes() if p == carried else b"",
                    )
                )
            yield record_batch(rows, SLICES)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        keys, ids, tags, pos, found = [], [], [], [], []
        for row in group.itertuples(index=False):
            found.append(np.frombuffer(row.fragments, np.int64).reshape(-1, len(FIELDS)))
            if not row.keys:
                continue
            keys.append(np.frombuffer(row.keys, np.uint64))
            length, start, per = unpacked(row.lengths), unpacked(row.starts), unpacked(row.counts)
            owner = np.cumsum(np.r_[np.frombuffer(row.ids[:8], np.int64), unpacked(row.ids[8:])])
            ids.append(np.repeat(np.repeat(owner, per), length))
            tags.append(np.repeat(np.repeat(unpacked(row.tags), per), length))
            inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            pos.append(np.repeat(start, length) + inside)
        if keys:
            keys, ids, tags, pos = (np.concatenate(x) for x in (keys, ids, tags, pos))
            order = np.argsort(keys, kind="stable")
            begin, length = runs(keys[order])
            often = order[np.repeat(length > 1, length)]
            often = often[np.lexsort((pos[often], tags[often], ids[often], keys[often]))]
            begin, length = runs(keys[often])
            source = np.repeat(often[begin], length)
            later = ids[often] != ids[source]
            often, source = often[later], source[later]
            back = np.argsort(often)
            often, source = often[back], source[back]
            found.append(fragments(ids[often], tags[often], pos[often], np.column_stack([ids[source], tags[source], pos[source]])))
        return pd.DataFrame(np.concatenate(found), columns=FIELDS)

    known = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return known.mapInArrow(send, SLICES).groupBy("part").applyInPandas(meet, FRAGMENT)


def paths(found: DataFrame) -> DataFrame:
    """Fragments that meet or overlap joined where document and source both run on."""
    keys = ["doc_id", "tag", "source_id", "source_tag", "shift"]
    # Repeated rows give their fragments again, and not always cut at the same places: what overlaps is one path too.
    ordered = found.withColumn("shift", F.col("source_start") - F.col("start")).groupBy(*keys, "start").agg(F.max("length").alias("length"))
    along = Window.partitionBy(*keys).orderBy("start")
    reached = F.max(F.col("start") + F.col("length")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    heads = ordered.withColumn("_head", F.when(F.col("start") <= reached, 0).otherwise(1))
    return (
        heads.withColumn("_path", F.sum("_head").over(along))
        .groupBy(*keys, "_path")
        .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("_end"))
        .select(
            "doc_id", "tag", "source_id", "source_tag", "start",
            (F.col("_end") - F.col("start")).alias("length"), (F.col("start") + F.col("shift")).alias("source_start"),
        )
    )


SMALL = "doc_id long, tag long, data binary"
CHECKED = "doc_id long, tag long, n_words long, n_removed long, kept_sha256 string, {}own array<string>, asked array<string>"


def applied(docs: DataFrame, spans: DataFrame, words: int, with_text: bool) -> tuple[DataFrame, DataFrame]:
    """Documents without the words under their spans, with digests of the words of own spans and of asked sources."""
    import zstandard

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        rows, size = [], 0
        for doc_id, data in texts(batches):
            rows.append((doc_id, tag_of(data), press.compress(data)))
            size += len(data)
            if size >= CHUNK_BYTES:
                yield record_batch(rows, SMALL)
                rows, size = [], 0
        yield record_batch(rows, SMALL)

    def digest(split: list[bytes], request) -> list[str]:
        return [
            hashlib.blake2b(b" ".join(split[r["start"] : r["start"] + r["length"] + words - 1]), digest_size=16).hexdigest() for r in request
        ]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                split = press.decompress(row.data).split() if row.data else []
                own = row.own if row.own is not None else []
                asked = row.asked if row.asked is not None else []
                if len(own):
                    change = np.zeros(len(split) + 1, np.int64)
                    for r in own:
                        change[r["start"]] += 1
                        change[r["start"] + r["length"] + words - 1] -= 1
                    free = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                    kept = b" ".join([split[k] for k in free])
                    removed = len(split) - len(free)
                else:
                    kept, removed = b" ".join(split), 0
                value = (row.doc_id, row.tag, len(split), removed, hashlib.sha256(kept).hexdigest())
                rows.append((*value, *([kept.decode()] if with_text else []), digest(split, own), digest(split, asked)))
            names = ["doc_id", "tag", "n_words", "n_removed", "kept_sha256", *(["text"] if with_text else []), "own", "asked"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    interval = F.array_sort(F.collect_set(F.struct("start", "length")))
    own = spans.groupBy("doc_id", "tag").agg(interval.alias("own"))
    asked = (
        spans.select(F.col("source_id").alias("doc_id"), F.col("source_tag").alias("tag"), F.col("source_start").alias("start"), "length")
        .groupBy("doc_id", "tag")
        .agg(interval.alias("asked"))
    )
    asks = written(own.join(asked, ["doc_id", "tag"], "full"), "substring-asks")
    small = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(shrink, SMALL)
    return small.join(asks, ["doc_id", "tag"], "left").mapInPandas(cut, CHECKED.format("text string, " if with_text else "")), asks


def mismatched(checked: DataFrame, asks: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans whose words differ from their source's."""

    def digests(kind: str, out: str) -> DataFrame:
        both = checked.filter(F.size(kind) > 0).select("doc_id", "tag", kind).distinct()
        joined = both.join(asks.select("doc_id", "tag", F.col(kind).alias("spans")), ["doc_id", "tag"])
        pairs = joined.select("doc_id", "tag", F.explode(F.arrays_zip("spans", kind)).alias("z"))
        return pairs.select("doc_id", "tag", F.col("z.spans.start").alias("start"), F.col("z.spans.length").alias("length"), F.col(f"z.{kind}").alias(out))

    copies = spans.join(digests("own", "copy"), ["doc_id", "tag", "start", "length"])
    sources = digests("asked", "source").select(
        F.col("doc_id").alias("source_id"), F.col("tag").alias("source_tag"), F.col("start").alias("source_start"), "length", "source"
    )
    both = copies.join(sources, ["source_id", "source_tag", "source_start", "length"], "left")
    return both.filter(~F.col("copy").eqNullSafe(F.col("source"))).select(*spans.columns)


def without_mismatches(spans: DataFrame, wrong: DataFrame) -> DataFrame:
    """Spans without the wrong ones, of which single windows are left to be compared anew; a wrong window is dropped."""
    steps = F.sequence(F.lit(0).cast("long"), F.col("length") - 1)
    apart = wrong.filter("length > 1").withColumn("_k", F.explode(steps)).withColumns(
        {"start": F.col("start") + F.col("_k"), "source_start": F.col("source_start") + F.col("_k"), "length": F.lit(1).cast("long")}
    )
    return spans.join(wrong, spans.columns, "left_anti").unionByName(apart.select(*spans.columns)).distinct()


def without_repeats(docs: DataFrame, words: int = WORDS, with_text: bool = False, hash_bits: int = 64) -> DataFrame:
    """Every document of a table with doc_id and text: words, words removed, digest of the kept ones (and their text).

    ``hash_bits`` of the windows' hashes are used; fewer than all make them collide, for tests.
    """
    found = written(repeated_fragments(docs, words, hash_bits=hash_bits), "substring-fragments")
    spans = written(paths(found), "substring-spans")
    while True:
        result, asks = applied(docs, spans, words, with_text)
        checked = written(result, "substring-checked")
        wrong = written(mismatched(checked, asks, spans), "substring-wrong")
        if not wrong.limit(1).count():
            return checked.drop("own", "asked", "tag")
        # Two more rounds at most: windows of wrong spans, then without the wrong ones among these.
        spans = written(without_mismatches(spans, wrong), "substring-spans")
