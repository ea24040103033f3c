"""Pack token sequences by multiway differencing.

Documents are cut: as many whole windows as they fill, and the rest in pieces
of at most a quarter window. Whole windows stand alone. The other pieces are
dealt by a hash into groups of bounded size, and each group is split into
near-equal windows by Karmarkar-Karp differencing: the two partial partitions
of widest spread are merged, largest against smallest, until one is left. If a
window exceeds the capacity, the group is split into one window more.

Only piece lengths take part; ids stay with their pieces. A null text is empty
and holds the end token alone. Rows with equal ids are separate documents whose
pieces share the id.
"""

from __future__ import annotations

import heapq
import string
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import CHUNK_BYTES, claim, hold, record_batch, texts
from tidemark.llm.common import spread, text_batches, text_of, written

CAPACITY = 4096
END_TOKEN = 2
GROUP_PIECES = 1024
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
# Entries of a generation of a word cache; two generations are held.
CACHE_WORDS = 200_000
# Marks that the tokenizer always separates from the letters before them, and keeps together, at the end of a word.
MARKS = string.punctuation
LATIN_END = "\u0250"

_encoders: dict[str, Callable[[str], bytes]] = {}


class Cache(dict):
    """Values made by a function, in two generations: what is not used while one fills up is dropped."""

    room = CACHE_WORDS

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value

    def forget(self) -> None:
        """Empty both generations."""
        self.clear()
        self.old = {}


class WordIds(Cache):
    """Ids of words as little-endian 32-bit integers.

    A word of letters is one piece for the tokenizer's model, and is made in
    lower case once for all its forms with capitals and closing marks, as the
    tokenizer folds case and splits marks off. All other words go through the
    whole tokenizer.
    """

    def __init__(self, tokenizer):
        super().__init__(self.made)
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.bytes_of = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        # Bytes as the byte-level alphabet writes them: printable Latin-1 as it is, the others from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.alphabet = {b: 256 + k for k, b in enumerate(others)}
        self.special = [token.content.lower() for token in tokenizer.get_added_tokens_decoder().values()]

    def folded(self, text: str) -> str:
        """The text in lower case where the tokenizer's folding is Python's: Latin-1 without special tokens, which it finds before."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        low = text.lower()
        return text if any(token in low for token in self.special) else low

    def made(self, word: str) -> bytes:
        stem = word.rstrip(MARKS)
        low = stem.lower()
        if stem.isascii():
            piece = low if stem.isalpha() else ""
        # Latin letters whose lower case is one letter each, composed already.
        elif stem.isalpha() and max(stem) < LATIN_END and len(low) == len(stem) and low.isalpha():
            piece = low.encode().decode("latin-1").translate(self.alphabet)
        else:
            piece = ""
        if not piece:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(low) < len(word):
            return self[low] + self[word[len(low) :]]
        if low != word:
            return self[low]
        bytes_of = self.bytes_of
        return b"".join([bytes_of[token.id] for token in self.tokenize(piece)])


def word_encoder(tokenizer_path: str) -> Callable[[str], bytes]:
    """Text to its token ids as little-endian 32-bit integers.

    The tokenizer drops white space and never joins what it separates, so the
    ids of a text are those of its words one after another, and a word is
    encoded once as long as a worker holds it. Only spaces and line feeds
    split words; other white space is left to the tokenizer.
    """
    if tokenizer_path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        words = WordIds(Tokenizer.from_file(tokenizer_path))
        hold("packing", words.forget)
        _encoders[tokenizer_path] = lambda text: b"".join(map(words.__getitem__, words.folded(text).replace("\n", " ").split(" ")))
    return _encoders[tokenizer_path]


def cuts(tokens: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin and end: whole windows, then quarters."""
    whole = tokens // capacity * capacity
    return [*range(0, whole, capacity), *range(whole, tokens, max(1, capacity // 4)), tokens]


def tokenised(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_token: int = END_TOKEN) -> DataFrame:
    """The pieces of every document of a table with doc_id and text, with their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing")
        encode = word_encoder(tokenizer_path)
        end = array("I", [end_token]).tobytes()
        rows, size = [], 0
        for doc_id, text in texts(batches):
            ids = encode(text.decode()) + end
            bounds = cuts(len(ids) // 4, capacity)
            for begin, stop in zip(bounds, bounds[1:], strict=False):
                if stop > begin:
                    rows.append((doc_id, begin, stop - begin, ids[4 * begin : 4 * stop], len(ids) // 4))
            size += len(ids)
            if size >= CHUNK_BYTES:
                yield record_batch(rows, PIECES)
                rows, size = [], 0
        yield record_batch(rows, PIECES)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, PIECES)


def differenced(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size: Karmarkar-Karp with as many windows as given."""
    if windows <= 1 or len(sizes) <= 1:
        return np.zeros(len(sizes), np.int64)
    nodes: list[tuple] = []
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        nodes.append((i,))
        heap.append((-size, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        sums = left + right[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        nodes.append((a, b, order))
        heapq.heappush(heap, (int(sums[-1] - sums[0]), len(nodes) - 1, sums))
    window = np.zeros(len(sizes), np.int64)
    # From the last merge down: which window each place of a partial partition has become.
    stack = [(heap[0][1], np.arange(windows))]
    while stack:
        node, places = stack.pop()
        if len(nodes[node]) == 1:
            window[nodes[node][0]] = places[0]
        else:
            a, b, order = nodes[node]
            merged = np.empty(windows, np.int64)
            merged[order] = places
            stack += [(a, merged), (b, merged[::-1])]
    return window


def packed_group(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows of a group; their number rises until none exceeds the capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differenced(sizes, windows)
        if not len(sizes) or np.bincount(window, weights=sizes).max() <= capacity:
            return window
        windows += 1


def packed(pieces: DataFrame, rows: int, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Stored pieces (``rows`` of them, told apart by column ``piece``) with sequence_id and offset."""
    groups = spread(rows, group_pieces)
    whole = pieces.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": F.col("piece") * 2, "offset": F.lit(0).cast("long")}
    )
    part = pieces.filter(F.col("length") < capacity).withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "start", "piece"), F.lit(groups))
    )
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long"

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "piece"], ascending=False, ignore_index=True)
        sizes = group["length"].to_numpy(np.int64)
        window = packed_group(sizes, capacity)
        group["sequence_id"] = ((group["group"].to_numpy(np.int64) << 24) | window) * 2 + 1
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        return group.drop(columns="group")

    return whole.unionByName(part.groupBy("group").applyInPandas(pack, schema))


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents to packed pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Only checksums of the ids are stored here; ``tokenised`` has the ids.
    """
    tokens = tokenised(docs, tokenizer_path, capacity)
    number = F.monotonically_increasing_id().alias("piece")
    with text_batches(docs.sparkSession):
        pieces = written(tokens.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", number), "pieces")
    return packed(pieces, pieces.count(), capacity).drop("piece")
