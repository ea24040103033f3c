"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    exact_dedup,
    fingerprints,
    html_text,
    language_id,
    mixing,
    near_dedup,
    packing,
    secret_scan,
    sharding,
    substring_dedup,
    vector_codes,
    whitening,
)

QUERIES = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    """Register the decorated function under its name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to source targets: how many words of each the mix takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken_words(mixed).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shards of near-equal bytes."""
    return sharding.kd_shards(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    """
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n_points,
               sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) = 1 AS kept,
           text_sha256
    FROM d
    """
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its group of equal texts that stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("text_hash")


@query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents' token sequences and their places in sequences of 4096."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, declaration, address suffix and host."""
    model = language_id.fit_text_model(table(spark, sf_dir, "documents"))
    return language_id.page_languages(table(spark, sf_dir, "pages"), model).select(
        "page_id", "host", "declared", "suffix", "language", "text_language", F.round("confidence", 6).alias("confidence")
    )


@query()
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    text = html_text.rendered(table(spark, sf_dir, "pages"))
    return text.select("page_id", "text", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query()
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query()
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in all documents, with the forest's score and verdict."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "position",
        F.sha2("secret", 256).alias("secret_sha256"),
        F.col("label").cast("int").alias("rule_label"),
        F.round("score", 6).alias("score"),
        (F.col("score") >= 0.5).alias("is_secret"),
    )


@query(
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), grams AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
            WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS gram
        FROM w
    ), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM grams a JOIN grams b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS MATERIALIZED (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)
    ), reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
    ), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
    """
)
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the component of their links at nine tenths of common three-word shingles."""
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


@query(
    r"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), places AS (
        SELECT doc_id, unnest(range(1, greatest(len(words) - 11, 1))) AS i, words FROM w
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win FROM places
    ), firsts AS (SELECT win, min(doc_id) AS least FROM windows GROUP BY win),
    hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (win) WHERE least < doc_id),
    gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hits, range(13) t(k)),
    singles AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
        FROM singles ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """
)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without passages of 13 words and more that a smaller id has."""
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents"))


@query()
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids and what they decode to, as digests."""
    tokens = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), TOKENIZER), TOKENIZER)
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _code_round(k: int) -> str:
    """Assignment by the codebooks of round ``k``, as distance * 256 + entry, and the codebooks after it."""
    return f"""a{k} AS (
        SELECT row, p, min(CAST(list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c) AS BIGINT) * 256 + e) AS m
        FROM parts JOIN b{k} USING (p) GROUP BY row, p
    ), means{k} AS (
        SELECT p, e, list(floor(total / n) ORDER BY i) AS c FROM (
            SELECT p, m % 256 AS e, i, sum(v[i]) AS total, count(*) AS n
            FROM (SELECT row, p, v, unnest(range(1, len(v) + 1)) AS i FROM parts) JOIN a{k} USING (row, p) GROUP BY ALL
        ) GROUP BY p, e
    ), b{k + 1} AS (SELECT p, e, coalesce(means{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN means{k} USING (p, e))"""


_CODES = f"""
    WITH v AS (
        SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS x
        FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
    ), parts AS (
        SELECT row, p, x[p * (len(x) // 4) + 1 : (p + 1) * (len(x) // 4)] AS v FROM v, range(4) t(p)
    ), b0 AS (SELECT p, row - 1 AS e, v AS c FROM parts WHERE row <= 256),
    {", ".join(_code_round(k) for k in range(4))},
    last AS (
        SELECT row, p, min(CAST(list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c) AS BIGINT) * 256 + e) AS m
        FROM parts JOIN b4 USING (p) GROUP BY row, p
    ), coded AS (
        SELECT row, string_agg(printf('%02x', m % 256), '' ORDER BY p) AS code, CAST(sum(m // 256) AS BIGINT) AS error FROM last GROUP BY row
    )
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(CAST(c[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i))
            FROM (SELECT p, e, c, unnest(range(1, len(c) + 1)) AS i FROM b4)) AS codebooks_sha256
    FROM v JOIN coded USING (row)
    """


@query(_CODES)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings with their errors, by codebooks of 256 entries fitted in four rounds."""
    codes, books = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256")
    return vector_codes.with_label_errors(codes).select("vec_id", "code", "error", "label_error", digest)


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the 16 strongest components of the distinct ones, each of variance one."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
