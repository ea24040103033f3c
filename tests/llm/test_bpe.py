"""BPE against the tokenizers library, and through Spark on awkward rows."""

from __future__ import annotations

import hashlib
import os
import random
from array import array

import pytest

from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES, TOKENIZER

os.environ["TOKENIZERS_PARALLELISM"] = "false"
ODD = list("abcdeXYZ'ss tt'llre vemd 12.,;!<|>\n\t\r\x0b\x0c\x1c\x85   ") + [
    *("<|endoftext|>", "<|startoftext|>", "Σ", "ς", "İ", "ǅ", "é", "é", "́", "̣̇", "가", "가", "Ⅷ", "½", "٣"),
    *("​", "﻿", "😀", "ß", "ﬁ", "क़", "　", "Å", "ẞ", "ͅ", "Ω", "ᫎ", "\U00010d51", "\U00016121"),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return array("I", ids).tobytes(), library.decode(ids, skip_special_tokens=False)


def test_random_strings(library):
    rng, vocabulary = random.Random(5), bpe.vocabulary(TOKENIZER)
    for _ in range(4000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 25)))
        text += "".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0xE000, 0x20000)])) for _ in range(rng.randint(0, 3)))
        ids, plain = expected(library, text)
        assert vocabulary.encode(text) == ids, ascii(text)
        assert vocabulary.decode(ids).decode() == plain


def test_every_code_point(library):
    vocabulary = bpe.vocabulary(TOKENIZER)
    for block in range(0, 0x20000, 4096):
        points = [chr(c) for c in range(block, block + 4096) if not 0xD800 <= c < 0xE000]
        text = " ".join(f"a{c}b1{c}" for c in points)
        assert vocabulary.encode(text) == expected(library, text)[0], hex(block)


def test_tables(spark, library):
    texts = [None, "", " \n ", "One word", "twice", "twice", "x" * 50_000 + " tail", "naïve Straße, <|endoftext|>!"]
    rows = [(i, t, 5, b"own", "taken") for i, t in enumerate(texts)] + [(3, "One word", 5, None, None), (None, "no id", 1, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids binary, decoded string").repartition(3)
    got = bpe.decoded(bpe.encoded(docs, TOKENIZER), TOKENIZER).collect()
    want = [(r[0], *expected(library, r[1])) for r in rows]
    assert sorted((str(r.doc_id), bytes(r.ids), r.decoded) for r in got) == sorted((str(i), ids, plain) for i, ids, plain in want)
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert bpe.decoded(bpe.encoded(docs.limit(0), TOKENIZER), TOKENIZER).collect() == []
    again = bpe.decoded(docs.select("doc_id", "decoded", "ids").filter("ids IS NULL"), TOKENIZER).collect()
    assert again and all(r.decoded == "" for r in again)


def test_query(spark, library):
    from tests.conftest import SF_TINY

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_TINY}/documents.parquet").collect()}
    got = QUERIES["op12_bpe"](spark, SF_TINY).collect()
    assert len(got) == len(texts)
    for r in got:
        ids, plain = expected(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(TOKENIZER.replace("word_bpe_49k", "byte_bpe_50k"))
