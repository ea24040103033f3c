"""BPE encoding and decoding with a vocabulary file that marks word ends.

A text is cut at its added tokens, normalised, split into pieces by the file's
pattern, and every piece becomes symbols, one a byte. The pairs of neighbouring
symbols that the vocabulary can merge wait in a priority queue, by rank and then
place. The least is taken and its two symbols become one in a doubly linked
list; the pairs on both sides enter the queue. An entry whose pair has changed
since is stale and passed over. A piece of n bytes takes n log n steps, so very
long ones do no harm.

Decoding concatenates the vocabulary's strings, with a space between two
tokens, which is how a file without a decoder is read.

Everything runs inside tasks on one batch at a time; nothing is shuffled. White
space is dropped and separates pieces, so the ids of a text are those of what
stands between spaces, and a worker keeps the ids of short words it has seen.

Null and empty texts have no ids and decode to the empty text; a null id list
does as well. Each row stands by itself: repeated rows and equal ids give rows
of their own, other columns are not looked at.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.arrays import CHUNK_BYTES, claim, hold, record_batch, texts
from tidemark.llm.common import text_of
from tidemark.llm.packing import Cache

ENCODED = "doc_id long, n_tokens long, ids binary"
# Bits of an entry of the queue that hold the place of its pair in the piece.
PLACE_BITS = 40
PLACE = (1 << PLACE_BITS) - 1
KNOWN_STEPS = {"NFC", "Replace", "Lowercase"}

_loaded: dict[str, Vocabulary] = {}


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as it is, the others from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


# Letters, digits and capitals that Unicode has had since version 16 (capitals: 17), which the
# tokenizer knows and Python does not. Ranges of code points; a capital with its small letter, or ranges of both.
LATER_LETTERS = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 "
    "113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"
)
LATER_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
LATER_CAPITALS = "1C89>1C8A A7CB>264 A7CC>A7CD A7CE>A7CF A7D2>A7D3 A7D4>A7D5 A7DA>A7DB A7DC>19B 10D50-10D65>10D70 16EA0-16EB8>16EBB"


def code_points(ranges: str) -> list[int]:
    """The code points of ranges in hexadecimal."""
    ends = [[int(x, 16) for x in r.split("-")] for r in ranges.split()]
    return [c for e in ends for c in range(e[0], e[-1] + 1)]


# Combining marks whose order the tokenizer does not know, and a letter that it does not compose.
LATER_MARKS = (
    "7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 "
    "10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 "
    "16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)
AT_LATER_MARK = regex.compile("([" + "".join(map(chr, code_points(LATER_MARKS))) + "])")
# Marks that are a piece of their own behind letters.
MARKS = ".,;:!?"


def members(category: str, later: str) -> str:
    """A general category as ranges of a character class: Python's own and the later ones.

    The pattern library's tables are of another Unicode than the tokenizer's.
    """
    later_ones = set(code_points(later))
    inside = [c for c in range(0x110000) if unicodedata.category(chr(c)).startswith(category) or c in later_ones]
    first = [c for c, before in zip(inside, [-2, *inside], strict=False) if before != c - 1]
    last = [c for c, after in zip(inside, [*inside[1:], -2], strict=True) if after != c + 1]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(first, last, strict=True))


def composed(text: str) -> str:
    """The text in form C as the tokenizer has it: later marks are left in place, and what stands between them is composed."""
    if unicodedata.is_normalized("NFC", text) and not AT_LATER_MARK.search(text):
        return text
    return "".join(part if k % 2 else unicodedata.normalize("NFC", part) for k, part in enumerate(AT_LATER_MARK.split(text)))


def later_capitals() -> dict[int, int]:
    """Capitals that Python does not know, with their small letters."""
    pairs = [pair.split(">") for pair in LATER_CAPITALS.split()]
    return {c: int(small, 16) + k for capitals, small in pairs for k, c in enumerate(code_points(capitals))}


class Vocabulary:
    """Merges, strings and rules of splitting of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, added = rules["model"], rules["added_tokens"]
        self.end = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.steps = (rules["normalizer"] or {}).get("normalizers", [])
        split, level = rules["pre_tokenizer"].get("pretokenizers") or ({}, {})
        if (
            model["type"] != "BPE"
            or not self.end
            or {s["type"] for s in self.steps} - KNOWN_STEPS
            or [split.get(k) for k in ("type", "behavior", "invert")] != ["Split", "Removed", True]
            or [level.get(k) for k in ("type", "use_regex", "add_prefix_space")] != ["ByteLevel", False, False]
            or rules["decoder"]
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"].split() != [t["content"]] or t["content"].isalpha() for t in added)
        ):
            raise ValueError(f"{path} splits, normalises or decodes in a way that is not known here")
        letters = byte_alphabet()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        # For each left symbol the right ones it merges with and their ranks, shifted past the place; the last has none.
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(vocab.values()) + 2)]
        self.products: list[int] = []
        for left, right in model["merges"]:
            self.ranks[vocab[left]][vocab[right]] = len(self.products) << PLACE_BITS
            self.products.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in added}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if added else None
        pattern = split["pattern"]["Regex"]
        for category, later in (("L", LATER_LETTERS), ("N", LATER_NUMBERS)):
            pattern = pattern.replace(f"\\p{{{category}}}", members(category, later))
        self.pieces = regex.compile(pattern)
        self.capitals = {**later_capitals(), ord("Σ"): ord("σ")}
        self.replaced = {i: regex.compile(s["pattern"]["Regex"]) for i, s in enumerate(self.steps) if s["type"] == "Replace"}
        strings = {**{i: s for s, i in vocab.items()}, **{i: s for s, i in self.special.items()}}
        self.strings = [strings.get(i, "").encode() for i in range(max(strings) + 1)]
        self.by_piece = Cache(self._piece_bytes)
        self.by_word = Cache(self._word_bytes)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        inner, products, ranks, push, pop = self.inner, self.products, self.ranks, heappush, heappop
        # A symbol that is gone is -1, as is the one beyond either end: no pair with it has a rank.
        symbols = [inner[b] for b in piece]
        symbols[-1] = self.last[piece[-1]]
        # An entry is rank and place in one integer; its pair is that of the rank.
        pairs = enumerate(zip(symbols, symbols[1:], strict=False))
        queue = [rank | at for at, (a, b) in pairs if (rank := ranks[a].get(b)) is not None]
        heapify(queue)
        count = len(symbols)
        symbols.append(-1)
        after, before = list(range(1, count + 2)), list(range(-1, count))
        while queue:
            entry = pop(queue)
            at = entry & PLACE
            right = after[at]
            if ranks[symbols[at]].get(symbols[right]) != entry - at:
                continue
            symbols[at] = product = products[entry >> PLACE_BITS]
            symbols[right] = -1
            after[at] = right = after[right]
            before[right] = at
            if (rank := ranks[product].get(symbols[right])) is not None:
                push(queue, rank | at)
            left = before[at]
            if (rank := ranks[symbols[left]].get(product)) is not None:
                push(queue, rank | left)
        return [s for s in symbols if s >= 0]

    def _piece_bytes(self, piece: str) -> bytes:
        return array("I", self.merged(piece.encode())).tobytes()

    def normalised(self, text: str) -> str:
        """The text after the file's steps."""
        plain = text.isascii()
        for i, step in enumerate(self.steps):
            if step["type"] == "Replace":
                text = self.replaced[i].sub(lambda _, to=step["content"]: to, text)
            elif step["type"] == "Lowercase":
                text = text.lower() if plain else text.translate(self.capitals).lower()
            elif not plain:
                text = composed(text)
        return text

    def _pieces_of(self, text: str) -> list[str]:
        """The pieces of a normalised text. One of letters alone, with or without closing marks, needs no pattern."""
        stem = text.rstrip(MARKS)
        if stem.isalpha():
            return [stem, text[len(stem) :]] if len(stem) < len(text) else [stem]
        return self.pieces.findall(text)

    def _word_bytes(self, word: str) -> bytes:
        by_piece = self.by_piece
        if word.isascii() and word.isalpha():
            return by_piece[word.lower()]
        if self.at_special is None or not self.at_special.search(word):
            return b"".join([by_piece[p] for p in self._pieces_of(self.normalised(word))])
        out = []
        for k, part in enumerate(self.at_special.split(word)):
            if k % 2:
                out.append(array("I", [self.special[part]]).tobytes())
            else:
                out += [by_piece[p] for p in self._pieces_of(self.normalised(part))]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.by_word.__getitem__, text.replace("\n", " ").split(" ")))

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 text of ids."""
        return b" ".join(map(self.strings.__getitem__, memoryview(ids).cast("I")))


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once a worker."""
    claim("bpe")
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
        for cache in (_loaded[path].by_piece, _loaded[path].by_word):
            hold("bpe", cache.forget)
    return _loaded[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every text of a table with doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary(path).encode
        rows, size = [], 0
        for doc_id, text in texts(batches):
            ids = encode(text.decode())
            rows.append((doc_id, len(ids) // 4, ids))
            size += len(ids)
            if size >= CHUNK_BYTES:
                yield record_batch(rows, ENCODED)
                rows, size = [], 0
        yield record_batch(rows, ENCODED)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, ENCODED)


def decoded(tokens: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with the text of its column ``ids`` as ``out``, which replaces a column of that name."""
    kept = tokens.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = vocabulary(path).decode
        for batch in batches:
            held: list[str] = []
            size = begin = 0
            for value in batch.column(ids):
                held.append(decode(value.as_py() or b"").decode())
                size += len(held[-1])
                if size >= CHUNK_BYTES or begin + len(held) == batch.num_rows:
                    part = batch.slice(begin, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.string())], names=[*part.schema.names, out])
                    begin, held, size = begin + len(held), [], 0

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(out, StringType())]))
