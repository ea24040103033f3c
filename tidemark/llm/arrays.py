"""Small array helpers used inside tasks: word hashes, packed integers, batches of documents."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext

# Entries of the word cache of a worker; it is emptied when full.
CACHE_WORDS = 200_000
# Bytes of text that are worked on at once.
CHUNK_BYTES = 2_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


_held: dict[str, list[Callable[[], None]]] = {}
_owner: list[str] = []


def hold(owner: str, forget: Callable[[], None]) -> None:
    """Note a cache that the tasks of ``owner`` keep in their worker, and how to empty it."""
    _held.setdefault(owner, []).append(forget)


def claim(owner: str) -> None:
    """Empty the caches of all others: workers outlive their tasks and come to other operators with what they hold.

    Costs nothing as long as the worker stays with one operator, so groups may call it.
    """
    if _owner == [owner]:
        return
    _owner[:] = [owner]
    others = [name for name in _held if name != owner]
    for name in others:
        for forget in _held[name]:
            forget()
    if others:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_words = WordHashes()
hold("words", _words.clear)


def hashes(words: list[bytes]) -> np.ndarray:
    """The hash of every word."""
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Values spread over all 64 bits."""
    values = (values ^ (values >> np.uint64(32))) * MULTIPLIER
    return values ^ (values >> np.uint64(29))


def sequences(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words; none if there are fewer."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(length):
        total = (total * np.uint64(0xD6E8FEB86659FD93)) + words[k : k + count]
    return mixed(total)


def carrier(number: int, bits: int) -> int:
    """The part of 2 ** ``bits`` that carries what a chunk has besides its slices, from the whole chunk number."""
    return int(mixed(mixed(np.array([number], np.uint64)))[0] >> np.uint64(64 - bits))


def packed(values: np.ndarray) -> bytes:
    """Integers of nought or more in as few bytes each as the largest needs."""
    top = int(values.max()) if len(values) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return begin, np.diff(np.r_[begin, len(values)])


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """Ids and UTF-8 texts of Arrow batches with doc_id and text, one by one, so that no batch is copied whole."""
    for batch in batches:
        large = pa.types.is_large_string(batch.schema.field("text").type)
        data = batch.column("text").cast(pa.large_binary() if large else pa.binary())
        for doc_id, text in zip(batch.column("doc_id"), data, strict=True):
            yield doc_id.as_py(), text.as_py()


def record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as an Arrow batch of a schema of longs, strings and binaries."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [pa.field(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=pa.schema(fields))


def document_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Documents (id and UTF-8 text) in chunks of bounded size, sorted by id, with a number no other chunk has.

    Numbers follow from the partition and the order in it. Both are those of
    the files read, so a task that is run again makes the same chunks.
    """
    claim("words")
    number = TaskContext.get().partitionId() << 32
    held: list[tuple[int, bytes]] = []
    size = 0
    for document in texts(batches):
        held.append(document)
        size += len(document[1])
        if size >= CHUNK_BYTES:
            yield number, sorted(held, key=lambda d: d[0])
            held, size, number = [], 0, number + 1
    if held:
        yield number, sorted(held, key=lambda d: d[0])
