"""Near-duplicate texts: a Jaccard self-join on word n-grams by T-occurrence search.

1. *Shared grams.* Documents become sets of gram hashes. A document needs at
   least T of its grams (T = threshold x set size, rounded up) in one other
   document, so grams that only one document has are found first, and documents
   with fewer than T shared grams drop out. Chunks of documents send each gram
   once, packed, to the part of the hash space it belongs to; parts send back
   which grams occur elsewhere.
2. *Classes.* Documents with equal sets are one class, represented by a number
   that stands for its smallest id. A document not all of whose grams are shared
   is a class of its own, as is each set where texts of one id differ.
3. *Blocks.* A representative's grams are ordered rarest first. Two linked
   documents share one of the first f - T + 1 (f: shared grams); documents that
   share one and whose sizes allow a link are chained, and the chains'
   components are cut into chunks of bounded size, in order of set size.
4. *Search.* Within each pair of chunks whose sizes allow a link, every
   document is a query against inverted lists: the short lists are merged and
   counted, the L longest ones probed by binary search for what reached T - L
   (DivideSkip), and documents with the required overlap are linked. Pairs that
   are connected already are passed over, so a task returns a forest.
5. *Components* of the links.

Grams found in one chunk more than once are sent as one, a representative
stands for all copies, and ordered chains are cut by range, so no key with a
large share of the rows meets in one task.

Null and empty texts have empty sets and link with nothing; so do rows with a
null id, whose component is null. Rows with equal ids count as documents of
their own and share the id's component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import carrier, claim, document_chunks, hashes, mixed, packed, record_batch, runs, sequences, unpacked
from tidemark.llm.common import WIDE_FILE_ROWS, running_total, salted_join, text_batches, text_of, written
from tidemark.llm.graph import components

PART_BYTES = 6_500_000
CHUNK_GRAMS = 400_000
SLICES = (
    "part long, chunk long, single binary, docs binary, counts binary, several binary, "
    "ids binary, sizes binary, local binary, local_counts binary"
)
RETURNED = "chunk long, grams binary, docs binary, counts binary, ids binary, sizes binary, local binary, local_counts binary"
KEY_BYTES = 6


def gram_set(text: bytes, words: int) -> np.ndarray:
    """The distinct n-grams of a text in lower case; a shorter text is one gram."""
    h = hashes(text.lower().split())
    if not len(h):
        return np.zeros(0, np.uint64)
    if len(h) < words:
        return mixed(sequences(h, len(h)) + np.uint64(len(h)))
    return np.unique(sequences(h, words))


def least_overlap(size: int, num: int, den: int) -> int:
    """Grams that a set must share with any set it links with."""
    return -(-num * size // den)


def _six(keys: np.ndarray, bits: int) -> bytes:
    """Keys of one part without the part's bits, six bytes each."""
    rest = (keys << np.uint64(bits)) >> np.uint64(64 - 8 * KEY_BYTES)
    return rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _from_six(data: bytes, part: int, bits: int) -> np.ndarray:
    wide = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    rest = wide.view("<u8").reshape(-1).astype(np.uint64) << np.uint64(64 - 8 * KEY_BYTES)
    return (rest >> np.uint64(bits)) | (np.uint64(part) << np.uint64(64 - bits))


def shared_grams(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Set size of every document; for those with enough shared grams also these grams and its class."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(8 * (8 - KEY_BYTES), max(3, math.ceil(math.log2(max(1, size / PART_BYTES)))))
    # Keys keep as many bits as a slice can carry.
    mask = ~np.uint64((1 << (64 - 8 * KEY_BYTES - bits)) - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in document_chunks(batches):
            sets = [np.unique(gram_set(text, words) & mask) for _, text in chunk]
            sizes = np.array([len(s) for s in sets])
            keys, doc = np.concatenate(sets), np.repeat(np.arange(len(chunk)), sizes)
            del sets
            order = np.argsort(keys, kind="stable")
            begin, length = runs(keys[order])
            alone = np.zeros(len(keys), bool)
            alone[order[begin[length == 1]]] = True
            several = keys[order[begin[length > 1]]]
            parts = (keys >> np.uint64(64 - bits)).astype(np.int64)
            single = np.flatnonzero(alone)
            single = single[np.argsort(parts[single], kind="stable")]
            ends = np.searchsorted(parts[single], np.arange((1 << bits) + 1))
            several_ends = np.searchsorted((several >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
            local_counts = np.bincount(doc[~alone], minlength=len(chunk))
            rows, carried = [], carrier(number, bits)
            for part in range(1 << bits):
                rows_of = single[ends[part] : ends[part + 1]]
                at, counts = runs(doc[rows_of])
                head = (None,) * 4
                if not len(rows_of) and several_ends[part] == several_ends[part + 1] and part != carried:
                    continue
                if part == carried:
                    ids = np.array([d[0] for d in chunk], np.int64)
                    head = (ids.tobytes(), packed(sizes), keys[~alone].tobytes(), packed(local_counts))
                rows.append(
                    (part, number, _six(keys[rows_of], bits), packed(doc[rows_of][at]), packed(counts))
                    + (_six(several[several_ends[part] : several_ends[part + 1]], bits), *head)
                )
            yield record_batch(rows, SLICES)

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        claim("words")
        part = int(group["part"].iloc[0])
        singles = [_from_six(x, part, bits) for x in group["single"]]
        everything = np.concatenate([*singles, *(_from_six(x, part, bits) for x in group["several"])])
        order = np.argsort(everything, kind="stable")
        begin, length = runs(everything[order])
        often = np.zeros(len(everything), bool)
        often[order] = np.repeat(length > 1, length)
        rows, at = [], 0
        for (_, row), keys in zip(group.iterrows(), singles, strict=True):
            here = often[at : at + len(keys)]
            at += len(keys)
            doc = np.repeat(unpacked(row["docs"]), unpacked(row["counts"]))[here]
            first, counts = runs(doc)
            rows.append((row["chunk"], keys[here].tobytes(), packed(doc[first]), packed(counts), row["ids"], row["sizes"], row["local"], row["local_counts"]))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RETURNED.split(", ")])

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        head = group[group["ids"].notna()].iloc[0]
        ids, sizes = np.frombuffer(head["ids"], np.int64), unpacked(head["sizes"])
        keys = [np.frombuffer(head["local"], np.uint64), *(np.frombuffer(g, np.uint64) for g in group["grams"])]
        doc = [np.repeat(np.arange(len(ids)), unpacked(head["local_counts"]))]
        doc += [np.repeat(unpacked(d), unpacked(c)) for d, c in zip(group["docs"], group["counts"], strict=True)]
        keys, doc = np.concatenate(keys), np.concatenate(doc)
        order = np.lexsort((keys, doc))
        keys, ends = keys[order], np.searchsorted(doc[order], np.arange(len(ids) + 1))
        grams: list = [None] * len(ids)
        classes: list = [None] * len(ids)
        for k, n in enumerate(sizes):
            own = keys[ends[k] : ends[k + 1]]
            if n and len(own) >= least_overlap(int(n), num, den):
                grams[k] = own.view(np.int64)
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest()
                classes[k] = digest if len(own) == n else f"d{ids[k]}-{n}-{digest}"
        return pd.DataFrame({"doc_id": ids, "n": sizes, "class": classes, "grams": grams})

    return (
        docs.select("doc_id", "text")
        .mapInArrow(send, SLICES)
        .groupBy("part")
        .applyInPandas(meet, RETURNED)
        .groupBy("chunk")
        .applyInPandas(gather, "doc_id long, n long, class string, grams array<long>")
    )


def chained(rows: DataFrame, num: int, den: int, most: int | None = None) -> DataFrame:
    """Edges between neighbours in the order of gram, size and id, where the sizes allow a link; ``most`` bounds the rows, if known."""
    order = ["gram", "n", "rep"]
    placed = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "near-order", most)
    near = (F.col("_gram") == F.col("gram")) & (F.col("_n") * den >= F.col("n") * num)
    within = Window.partitionBy("_part").orderBy(*order)
    inside = placed.select("gram", "n", "rep", *[F.lag(c).over(within).alias(f"_{c}") for c in order])
    one = F.struct(*order)
    ends = placed.groupBy("_part").agg(F.min(one).alias("first"), F.max(one).alias("last"))
    across = ends.withColumn("before", F.lag("last").over(Window.orderBy("_part"))).select(
        "first.*", *[F.col(f"before.{c}").alias(f"_{c}") for c in order]
    )
    return inside.unionByName(across).filter(near).select(F.col("rep").alias("a"), F.col("_rep").alias("b")).distinct()


def blocks(reps: DataFrame, num: int, den: int) -> DataFrame:
    """Candidates by block and chunk, numbered within their block in order of size."""
    rows = reps.select("rep", "n", F.size("grams").alias("f"), F.explode("grams").alias("gram"))
    often = rows.groupBy("gram").agg(F.count("*").alias("df"))
    least = F.ceil(F.col("n") * num / den)
    first = F.row_number().over(Window.partitionBy("rep").orderBy("df", "gram"))
    prefix = rows.join(often, "gram").withColumn("_at", first).filter((F.col("_at") <= F.col("f") - least + 1) & (F.col("df") > 1))
    known = reps.agg(F.count("*"), F.sum(F.size("grams") - least + 1)).first()
    count, most = known[0], known[1] or 0
    block = components(chained(prefix.select("gram", "n", "rep"), num, den, most), most)
    members = written(
        reps.join(block.select(F.col("node").alias("rep"), F.col("component").alias("block")), "rep"), "near-members", count, WIDE_FILE_ROWS
    )
    counted = members.select("block", "n", "rep", F.size("grams").cast("long").alias("weight"))
    placed = running_total(counted, ["block", "n", "rep"], "weight", "at", "near-places", count)
    starts = placed.groupBy("block").agg(F.min("at").alias("_start"))
    numbered = placed.join(starts, "block").select("rep", F.floor((F.col("at") - F.col("_start")) / CHUNK_GRAMS).alias("chunk"))
    return written(members.join(numbered, "rep"), "near-chunks", count, WIDE_FILE_ROWS)


def divide_skip(ids: np.ndarray, sizes: np.ndarray, grams: list[np.ndarray], sides: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A forest of the links between documents of a block; ``sides`` 0 is the index, 1 the queries, 2 both."""
    parent = list(range(len(ids)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    indexed = np.flatnonzero(sides != 1)
    keys = np.concatenate([grams[k] for k in indexed]) if len(indexed) else np.zeros(0, np.int64)
    owner = np.repeat(indexed, [len(grams[k]) for k in indexed])
    order = np.argsort(keys, kind="stable")  # lists stay sorted by document
    keys, owner = keys[order], owner[order]
    begin, length = runs(keys)
    names = keys[begin]
    links = []
    for q in np.flatnonzero(sides != 0):
        size, own = int(sizes[q]), grams[q]
        smallest = -(-num * size // den)
        needed = -(-num * (size + smallest) // (num + den))
        where = np.searchsorted(names, own)
        where = where[(where < len(names)) & (names[np.minimum(where, max(0, len(names) - 1))] == own)] if len(names) else where[:0]
        if len(where) < needed:
            continue
        where = where[np.argsort(length[where], kind="stable")]
        long_lists = needed - max(1, needed // 10)
        short = where[: len(where) - long_lists]
        found, counts = np.unique(np.concatenate([owner[begin[w] : begin[w] + length[w]] for w in short]), return_counts=True)
        fits = (sizes[found] * den >= size * num) & (sizes[found] * num <= size * den) & (found != q)
        if sides[q] == 2:
            fits &= found < q
        keep = fits & (counts >= needed - long_lists)
        found, counts = found[keep], counts[keep]
        if not len(found):
            continue
        mine = root(q)
        apart = np.array([root(k) != mine for k in found])
        found, counts = found[apart], counts[apart]
        rest = where[len(where) - long_lists :]
        target = -(-num * (size + sizes[found]) // (num + den))
        for k, w in enumerate(rest):
            if not len(found):
                break
            postings = owner[begin[w] : begin[w] + length[w]]
            at = np.minimum(np.searchsorted(postings, found), len(postings) - 1)
            counts = counts + (postings[at] == found)
            alive = counts + (len(rest) - k - 1) >= target
            if not alive.all():
                found, counts, target = found[alive], counts[alive], target[alive]
        for k in found[counts >= target]:
            if root(k) != root(q):
                parent[root(k)] = root(q)
                links.append((int(ids[q]), int(ids[k])))
    return links


def links(candidates: DataFrame, num: int, den: int) -> DataFrame:
    """Links between stored candidates, enough to connect all that are connected."""
    count = candidates.count()
    ranges = candidates.groupBy("block", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = ranges.select("block", F.col("chunk").alias("chunk2"), F.col("low").alias("low2"))
    pairs = written(
        ranges.join(other, "block")
        .filter((F.col("chunk") <= F.col("chunk2")) & (F.col("high") * den >= F.col("low2") * num))
        .select("block", "chunk", "chunk2"),
        "near-pairs",
        count,
    )
    rows = candidates.select("block", F.col("chunk").alias("_chunk"), "rep", "n", "grams")
    left = pairs.withColumn("_chunk", F.col("chunk")).withColumn("side", F.when(F.col("chunk") == F.col("chunk2"), 2).otherwise(0))
    right = pairs.filter("chunk != chunk2").withColumn("_chunk", F.col("chunk2")).withColumn("side", F.lit(1))
    sent = rows.join(left.unionByName(right), ["block", "_chunk"])

    def search(group: pd.DataFrame) -> pd.DataFrame:
        claim("search")
        group = group.sort_values(["n", "rep"], ignore_index=True)
        found = divide_skip(
            group["rep"].to_numpy(np.int64), group["n"].to_numpy(np.int64), list(group["grams"]), group["side"].to_numpy(), num, den
        )
        return pd.DataFrame(found, columns=["a", "b"])

    return sent.groupBy("block", "chunk", "chunk2").applyInPandas(search, "a long, b long")


def near_groups(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Every document with its set size (n_shingles) and component_id: the smallest doc_id it is connected with.

    Two documents are linked when den x intersection >= num x union of their
    n-gram sets.
    """
    known = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), text_of().alias("text"))
    with text_batches(docs.sparkSession):
        sets = written(shared_grams(known, words, num, den), "near-sets")
    count = sets.count()
    able = sets.filter(F.col("grams").isNotNull())
    first = Window.partitionBy("class").orderBy("doc_id")
    one = able.withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    # An id may have several sets, so representatives have numbers of their own; stored, they stay as they are.
    reps = written(one.select("class", F.monotonically_increasing_id().alias("rep"), F.col("doc_id").alias("least"), "n", "grams"), "near-reps", count, WIDE_FILE_ROWS)
    to_class = written(able.select("doc_id", "class").distinct().join(reps.select("class", "rep", "least"), "class"), "near-classes", count)
    # Rows that share an id may be in several classes: the id connects them.
    same_id = to_class.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count("*").alias("k")).filter("k > 1")
    same = to_class.join(same_id.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b")).filter("a != b")
    found = components(links(blocks(reps.select("rep", "n", "grams"), num, den), num, den).unionByName(same), count)
    members = found.withColumnRenamed("node", "rep").join(reps.select("rep", "least"), "rep")
    lowest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    named = salted_join(members.drop("least"), lowest, ["component"], F.col("rep"), grows=True).select("rep", "component_id")
    own = to_class.groupBy("doc_id").agg(F.min(F.struct("rep", "least")).alias("_own")).select("doc_id", "_own.rep", "_own.least")
    linked = own.join(named, "rep", "left").select("doc_id", F.coalesce("component_id", "least").alias("component_id"))
    result = sets.select("doc_id", F.col("n").alias("n_shingles")).join(linked, "doc_id", "left")
    result = result.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    unknown = docs.filter(F.col("doc_id").isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return result.unionByName(unknown)
