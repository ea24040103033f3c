"""A corpus pipeline: language ID, exact and near duplicates, mixing to target weights, packing.

Every stage but the last takes and returns a table with the columns of
``documents``; its result is written and read again as the next one's input.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language_id, mixing, near_dedup, packing
from tidemark.llm.common import salted_join, single_rows, text_of, without_space, written
from tidemark.llm.queries import TOKENIZER


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have text and whose language is one of the labelled ones.

    All evidence counts, so a text too short for trigrams stays if its declared
    language or source tells. Null texts and those of white space alone go. A
    row is judged by its own declared language and source; repeated rows stay.
    """
    model = language_id.fit_text_model(docs)
    found = language_id.document_languages(docs, model).filter(F.col("language") == language_id.UNKNOWN)
    keys = {"doc_id": "__doc", "text_hash": "__text", "declared": "__lang", "host": "__source"}
    gone = written(found.select(*[F.col(k).alias(name) for k, name in keys.items()]).distinct(), "pipeline-languages")
    own = [F.col("doc_id"), F.xxhash64("text"), F.lower("lang"), F.col("source")]
    same = reduce(and_, [mine.eqNullSafe(F.col(name)) for mine, name in zip(own, keys.values(), strict=True)])
    return docs.filter(without_space(text_of()) != "").join(gone, same, "left_anti").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.kept_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of texts alike by five-word shingles.

    Rows are told apart by id and text: of texts that share an id (or have
    none) each gets a number of its own for the search, so an unrelated text
    does not go with a near copy of its id. Null ids come last in their group.
    Of rows with equal id and text one stays.
    """
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    keys = written(hashed.groupBy("doc_id", "text_hash").count(), "pipeline-keys", docs.count())
    rows = keys.count()
    many = keys.groupBy(F.col("doc_id").alias("_id")).count().filter("count > 1 OR _id IS NULL").select("_id")
    lowest = min(keys.agg(F.min("doc_id")).first()[0] or 0, 0)
    texts_apart = keys.join(many, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), (F.lit(lowest - 1) - F.monotonically_increasing_id()).alias("__number")
    )
    numbers = written(texts_apart, "pipeline-numbers")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.xxhash64("text").eqNullSafe(F.col("__text"))
    numbered = docs.join(numbers, same, "left").withColumn("__number", F.coalesce("__number", "doc_id"))
    groups = near_dedup.near_groups(numbered.select(F.col("__number").alias("doc_id"), "text"), words=5, num=80, den=100)
    known = written(groups.groupBy("doc_id", "component_id").count().drop("count"), "pipeline-groups", rows)
    named = known.join(numbers, F.col("doc_id") == F.col("__number"), "left").select(
        F.col("doc_id").alias("number"), "component_id", F.when(F.col("__number").isNull(), F.col("doc_id")).otherwise(F.col("__doc")).alias("id")
    )
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", (-F.col("number")).alias("n")))
    stays = named.groupBy("component_id").agg((-first["n"]).alias("_stays"))
    rest = salted_join(named, stays, ["component_id"], F.col("number"), grows=True).filter("number != _stays")
    gone = written(rest.select(F.col("number").alias("__gone")), "pipeline-near", rows)
    kept = numbered.join(gone, F.col("__number") == F.col("__gone"), "left_anti").select(*docs.columns)
    return single_rows(kept, keys.withColumn("copies", F.explode(F.sequence(F.lit(1), F.least("count", F.lit(2)))))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row per document and pass."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences."""
    return packing.packed_documents(docs, TOKENIZER)


STAGES = [
    ("language_id", in_known_language),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("mixing", mixed),
    ("packing", in_sequences),
]

# Language ID is a fitted model and the mix follows pseudorandom draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
