"""Vector code compression: product codebooks fitted in whole numbers over Hilbert-sorted blocks.

1. *Points.* Vectors become whole numbers and are cut into consecutive parts.
2. *Blocks.* The points of each part are sorted along a Hilbert curve and cut
   into flat blocks, each stored with its box (least and largest value per
   dimension) and its sums.
3. *Rounds.* For each block and codebook entry the nearest and farthest
   distance of the box are bounds. An entry that is farther at best than
   another at worst cannot win any point, so the rest is the block's shortlist.
   One entry left takes the block's stored sums; else a small kernel finds each
   point's nearest of the shortlist. Tasks return sums per entry, which are
   added by a grouped aggregation.
4. *Codes.* After the last round every point is assigned once more, and the
   parts of a row are brought together.

Distances are exact whole numbers: in 64-bit floats while all products stay
below 2 ** 53, else in 64-bit integers. Only codebooks reach the driver (a
bounded number of entries), and the seeds. Blocks are dealt by curve and row,
so that a vector with a third of all rows is spread over tasks like any other.

Rows left out: see ``whole_vectors``; components from 2 ** 17 on are left out
too, as their squares need not fit into a long. Repeated rows and ids are
vectors of their own. Among equal ids seeds are taken by their numbers. Vectors
whose length does not divide evenly have one component more in the first
parts. Fewer vectors than entries make a smaller codebook; an empty table an
empty result. Sums of errors beyond a long are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import written
from tidemark.llm.vectors import whole_vectors

SCALE = 1024
LARGEST = float(1 << 17)
PARTS, ENTRIES, ROUNDS = 4, 256, 4
BLOCK_POINTS = 256
# Blocks whose boxes are compared with a codebook at once.
BATCH_BLOCKS = 32
CURVE_BITS = 60
POINTS = "part int, curve long, row long, point binary"
BLOCKS = "part int, size int, rows binary, points binary, low binary, high binary, sums binary"
SUMS = "part int, entry int, sums array<long>"
CODES = "row long, part int, code int, distance long"


def bounds(dimension: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin and end; the first ones are longer where it does not divide."""
    each, more = divmod(dimension, parts)
    return [p * each + min(p, more) for p in range(parts + 1)]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of points (rows of coordinates below 2 ** bits), as non-negative longs.

    The axes are turned into the transposed curve index by exchanging and
    inverting lower bits, coarse to fine, then Gray-decoded.
    """
    x = points.astype(np.uint64).T.copy()
    count = len(x)
    if not count:
        return np.zeros(points.shape[0], np.int64)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        low = q - one
        for i in range(count):
            up = (x[i] & q) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, count):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        flip ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
    x ^= flip
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(count):
            place = (place << one) | ((x[i] >> np.uint64(b)) & one)
    return place.astype(np.int64)


def cells(points: np.ndarray, centre: np.ndarray, width: np.ndarray, bits: int) -> np.ndarray:
    """Grid coordinates of points; what lies outside the grid counts to its edge."""
    side = 1 << bits
    return np.clip(np.floor((points - centre) / width * side + side / 2), 0, side - 1)


def curve_points(rows: DataFrame, dimension: int, seeds: np.ndarray) -> DataFrame:
    """Every part of every row with its place on the curve. The seeds' spread sets the grid, which only steers efficiency."""
    ends = bounds(dimension)
    centre, width = seeds.mean(axis=0), np.maximum(1.0, 5 * seeds.std(axis=0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            row = batch.column("row")
            for p, (begin, end) in enumerate(zip(ends, ends[1:], strict=False)):
                part = np.ascontiguousarray(x[:, begin:end].astype("<i4"))
                on_axes = min(end - begin, CURVE_BITS)
                bits = min(16, CURVE_BITS // max(1, on_axes))
                at = slice(begin, begin + on_axes)
                curve = hilbert(cells(part[:, :on_axes], centre[at], width[at], bits), bits)
                data = pa.array([v.tobytes() for v in part], pa.binary())
                numbers = pa.array(np.full(len(part), p, np.int32))
                yield pa.RecordBatch.from_arrays([numbers, pa.array(curve), row, data], names=["part", "curve", "row", "point"])

    return rows.select("row", "x").mapInArrow(run, POINTS)


def blocks(points: DataFrame, dimension: int) -> DataFrame:
    """Points in flat blocks of neighbours on the curve, stored."""
    ends = bounds(dimension)
    order = ["part", "curve", "row"]

    def block(part: int, rows: np.ndarray, x: np.ndarray) -> dict:
        narrow = x.astype("<i2") if np.abs(x).max(initial=0) < 1 << 15 else x.astype("<i4")
        box = {"low": x.min(axis=0), "high": x.max(axis=0), "sums": x.sum(axis=0)}
        return {"part": part, "size": len(x), "rows": rows.tobytes(), "points": narrow.tobytes(), **{k: v.astype("<i8").tobytes() for k, v in box.items()}}

    schema = pa.schema([("part", pa.int32()), ("size", pa.int32()), *[(c, pa.binary()) for c in ("rows", "points", "low", "high", "sums")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, np.ndarray, np.ndarray] | None = None
        for batch in batches:
            parts, rows = batch.column("part").to_numpy(), batch.column("row").to_numpy()
            out = []
            for p in np.unique(parts):
                here = np.flatnonzero(parts == p)
                data = batch.column("point").slice(here[0], len(here)).to_pylist()
                x = np.frombuffer(b"".join(data), "<i4").reshape(len(here), ends[p + 1] - ends[p]).astype(np.int64)
                mine = rows[here]
                if held is not None and held[0] == p:
                    mine, x = np.r_[held[1], mine], np.r_[held[2], x]
                elif held is not None:
                    out.append(block(*held))
                whole = len(x) // BLOCK_POINTS * BLOCK_POINTS
                out += [block(int(p), mine[k : k + BLOCK_POINTS], x[k : k + BLOCK_POINTS]) for k in range(0, whole, BLOCK_POINTS)]
                held = (int(p), mine[whole:], x[whole:]) if whole < len(x) else None
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([block(*held)], schema=schema)

    return written(points.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, BLOCKS), "vector-blocks")


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Blocks x entries: which entries can be nearest to a point of the block's box."""
    below, above = low[:, None, :] - book[None], book[None] - high[:, None, :]
    nearest = (np.maximum(0, np.maximum(below, above)) ** 2).sum(axis=2)
    farthest = (np.maximum(book[None] - low[:, None, :], high[:, None, :] - book[None]) ** 2).sum(axis=2)
    return nearest <= farthest.min(axis=1)[:, None]


def nearest_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point, the lowest among equals, and its squared distance."""
    top = int(max(np.abs(points).max(initial=0), np.abs(book).max(initial=0)))
    # Floats multiply faster and are exact while nothing exceeds their 53 bits.
    kind = np.float64 if 4 * top * top * max(1, points.shape[1]) < 1 << 53 else np.int64
    p, b = points.astype(kind), book.astype(kind)
    rest = (b * b).sum(axis=1)[None, :] - 2 * (p @ b.T)
    best = rest.argmin(axis=1)
    distance = (p * p).sum(axis=1) + rest[np.arange(len(p)), best]
    return best, distance.astype(np.int64)


def boxed(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Part, row numbers, points, sums and shortlist of every block of Arrow batches."""
    for batch in batches:
        rows = batch.to_pylist()
        for p, book in enumerate(books):
            mine = [r for r in rows if r["part"] == p]
            width = book.shape[1]
            for k in range(0, len(mine), BATCH_BLOCKS):
                some = mine[k : k + BATCH_BLOCKS]
                low, high, sums = (np.frombuffer(b"".join(r[c] for r in some), "<i8").reshape(len(some), width) for c in ("low", "high", "sums"))
                for r, listed, total in zip(some, shortlists(low, high, book), sums, strict=True):
                    kind = "<i2" if len(r["points"]) == 2 * width * r["size"] else "<i4"
                    points = np.frombuffer(r["points"], kind).reshape(r["size"], width).astype(np.int64)
                    yield p, np.frombuffer(r["rows"], "<i8"), points, total, np.flatnonzero(listed)


def round_sums(stored: DataFrame, books: list[np.ndarray]) -> dict[tuple[int, int], list[int]]:
    """For each part and entry the sums of its points, and their number last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for p, _, points, sums, listed in boxed(batches, books):
            if len(listed) == 1:
                totals[p][listed[0]] += np.r_[sums, len(points)]
                continue
            best, _ = nearest_entries(points, books[p][listed])
            of_entry = (best[None, :] == np.arange(len(listed))[:, None]).astype(np.int64)
            totals[p][listed] += np.c_[of_entry @ points, of_entry.sum(axis=1)]
        found = [(p, k, t[k].tolist()) for p, t in enumerate(totals) for k in np.flatnonzero(t[:, -1])]
        parts, entries, sums = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array(entries, pa.int32()), pa.array(sums, pa.list_(pa.int64()))], names=["part", "entry", "sums"]
        )

    each = stored.mapInArrow(run, SUMS).select("part", "entry", F.posexplode("sums"))
    totals = each.groupBy("part", "entry", "pos").agg(F.sum("col").alias("total")).orderBy("part", "entry", "pos").collect()
    found: dict[tuple[int, int], list[int]] = {}
    for r in totals:
        found.setdefault((r.part, r.entry), []).append(r.total)
    return found


def next_books(books: list[np.ndarray], sums: dict[tuple[int, int], list[int]]) -> list[np.ndarray]:
    """Entries replaced by the floors of their points' means; unused ones stay."""
    after = [b.copy() for b in books]
    for (p, k), total in sums.items():
        after[p][k] = [s // total[-1] for s in total[:-1]]
    return after


def point_codes(stored: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Row, part, code and squared distance of every point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, rows, points, _, listed in boxed(batches, books):
            best, distance = nearest_entries(points, books[p][listed])
            columns = [rows, np.full(len(rows), p, np.int32), listed[best].astype(np.int32), distance]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "part", "code", "distance"])

    return stored.mapInArrow(run, CODES)


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' integers in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def compressed(vectors: DataFrame, column: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code (hexadecimal, two digits a part) and error of every row that is kept, and the codebooks."""
    spark, source = vectors.sparkSession, vectors.schema
    tagged = whole_vectors(vectors, column, ["vec_id", "label", F.monotonically_increasing_id().alias("row")], SCALE, 0, LARGEST, "vector-rows")
    rows = tagged.select("row", "vec_id", "label", F.col("x").cast("array<int>").alias("x"))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    if not first:
        kinds = [StructField("vec_id", LongType()), source["label"], StructField("code", StringType()), StructField("error", LongType())]
        return spark.createDataFrame([], StructType(kinds)), []
    seeds = np.array([r.x for r in first], np.int64)
    ends = bounds(seeds.shape[1])
    books = [seeds[:, a:b] for a, b in zip(ends, ends[1:], strict=False)]
    stored = blocks(curve_points(rows, seeds.shape[1], seeds), seeds.shape[1])
    for _ in range(rounds):
        books = next_books(books, round_sums(stored, books))
    codes = point_codes(stored, books)
    both = codes.unionByName(rows.select("row", F.col("vec_id").cast("long").alias("vec_id"), "label"), allowMissingColumns=True)
    of_part = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("code"))))), 2, "0") for p in range(PARTS)]
    whole = both.groupBy("row").agg(
        F.any_value("vec_id", True).alias("vec_id"),
        F.any_value("label", True).alias("label"),
        F.concat(*of_part).alias("code"),
        F.sum("distance").alias("error"),
    )
    return written(whole.drop("row"), "vector-codes"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error: the errors of all rows of the label, nulls together."""
    sums = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
