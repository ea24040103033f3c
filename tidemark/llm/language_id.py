"""Language of texts by Bayesian fusion of evidence.

Four kinds of evidence are multiplied: the likelihood of the text's byte
trigrams under each language, the language its markup declares, the suffix of
its address, and a prior for its host. Likelihoods of declarations and suffixes
and the host priors come from grouped sums of the texts' own posteriors over
all rows. Host priors are smoothed along global, domain, host; a row's own
posterior is left out of its prior.

``UNKNOWN`` is a class of its own with all trigrams equally likely. A row
without text has no text likelihood and goes by the other evidence; missing
evidence (null) says nothing. Rows with equal ids are separate rows.

The trigram model is fitted on at most ``SAMPLE_ROWS`` labelled documents of
each language, those with the smallest hashes of their ids.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import claim
from tidemark.llm.common import salted_join, smallest_hashes, text_batches, text_of, written

SAMPLE_ROWS = 2000
BUCKETS = 1 << 16
SMOOTHING = 0.05
# Neighbouring trigrams share two bytes, so a text counts as a third of its trigrams.
TEMPER = 1 / 3
EVIDENCE_SMOOTHING = 1.0
PRIOR_WEIGHT = 5.0
UNKNOWN = "und"
UNSEEN_MARKUP = re.compile(r"(?is)<!--.*?-->|<(script|style|head|title)\b.*?</\1\s*>|<[^>]*>")
CHUNK = 1 << 20


@dataclass
class TextModel:
    """Log-likelihoods of trigram buckets, one column per language, ``UNKNOWN`` last."""

    languages: list[str]
    weights: np.ndarray


def trigrams(data: bytes) -> np.ndarray:
    """The bucket of every byte trigram."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    mixed = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
    return mixed >> np.uint32(16)


def chunks(text: str) -> Iterator[np.ndarray]:
    """Trigram buckets of a text in chunks of bounded size that overlap by two bytes."""
    data = text.lower().encode("utf-8", "replace")
    for begin in range(0, max(0, len(data) - 2), CHUNK):
        yield trigrams(data[begin : begin + CHUNK + 2])


def fit_text_model(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """Fit the trigram model on a table with doc_id, text and lang."""
    labelled = docs.select("doc_id", "lang").filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counts = labelled.groupBy("lang").agg(F.count("*").alias("_rows"))
    ids = written(smallest_hashes(labelled, counts, "lang", "doc_id", sample_rows).distinct(), "language-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("language")
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for codes in chunks(text):
                    total += np.bincount(codes, minlength=BUCKETS)
        yield pd.DataFrame({"lang": list(counts), "counts": [c.tobytes() for c in counts.values()]}, columns=["lang", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in group["counts"])
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "counts": [total.tobytes()]})

    schema = "lang string, counts binary"
    sample = docs.select("doc_id", "lang", text_of().alias("text")).join(ids, ["doc_id", "lang"])
    with text_batches(docs.sparkSession):
        rows = sorted((r.lang, r.counts) for r in sample.mapInPandas(count, schema).groupBy("lang").applyInPandas(add, schema).collect())
    columns = []
    for _, counts in rows:
        c = np.frombuffer(bytes(counts), np.int64) + SMOOTHING
        columns.append(np.log(c / c.sum()))
    columns.append(np.full(BUCKETS, -np.log(BUCKETS)))
    return TextModel([r[0] for r in rows] + [UNKNOWN], np.stack(columns, axis=1).astype(np.float32))


def with_likelihoods(rows: DataFrame, model: TextModel, column: str, markup: bool) -> DataFrame:
    """``rows`` with ``likelihoods`` (an array in the order of the model's languages) instead of ``column``."""
    kept = [f for f in rows.schema if f.name != column]
    spread = rows.sparkSession.sparkContext.broadcast(model.weights)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "likelihoods array<double>", "grams long"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("language")
        weights = spread.value
        for batch in batches:
            sums, grams = [], []
            for text in batch[column]:
                text = html.unescape(UNSEEN_MARKUP.sub(" ", text)) if markup else text
                total, n = np.zeros(weights.shape[1]), 0
                for codes in chunks(text):
                    total += weights[codes].sum(axis=0, dtype=np.float64)
                    n += len(codes)
                sums.append(((total - total.max()) * TEMPER).tolist())
                grams.append(n)
            yield batch.drop(columns=column).assign(likelihoods=sums, grams=grams)

    nullable = rows.withColumn(column, F.coalesce(F.col(column), F.lit("")))
    return nullable.mapInPandas(run, schema)


def address_parts(url: Column) -> dict[str, Column]:
    """Host, domain and suffix of an address; null without a host."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(host != "", host)
    labels = F.split(host, r"\.")
    return {"host": host, "domain": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(3)), 3), "."), "suffix": F.element_at(labels, -1)}


def fused(evidence: DataFrame, languages: list[str], key: str) -> DataFrame:
    """Posterior language of rows with key, declared, suffix, domain, host, likelihoods and grams."""
    size = len(languages)
    top = F.aggregate("likelihoods", F.lit(float("-inf")), lambda a, x: F.greatest(a, x))
    exps = F.transform("likelihoods", lambda x: F.exp(x - F.col("_top")))
    with text_batches(evidence.sparkSession):
        alone = written(
            evidence.withColumn("_top", top)
            .withColumn("_exp", exps)
            .withColumn("_sum", F.aggregate("_exp", F.lit(0.0), lambda a, x: a + x))
            .withColumn("p", F.transform("_exp", lambda x: x / F.col("_sum")))
            .drop("_top", "_exp", "_sum"),
            "language-evidence",
        )
    sums = F.array(*[F.sum(F.col("p")[i]) for i in range(size)])

    def total(*by: str) -> DataFrame:
        return alone.groupBy(*by).agg(sums.alias("s"), F.count("*").alias("n"))

    overall = total().first()
    everything = [float(x or 0.0) for x in (overall["s"] or [0.0] * size)]
    rows = float(overall["n"])

    def likelihood(column: str) -> DataFrame:
        """log P(value | language), one row per value."""
        values = written(total(column).filter(F.col(column).isNotNull()), f"language-{column}")
        kinds = values.count() + 1
        return values.select(
            column,
            F.array(
                *[F.log((F.col("s")[i] + EVIDENCE_SMOOTHING) / (everything[i] + EVIDENCE_SMOOTHING * kinds)) for i in range(size)]
            ).alias(f"_{column}"),
        )

    uid = F.xxhash64(key, "grams")
    hosts = total("domain", "host").select("domain", "host", F.col("s").alias("_hs"), F.col("n").alias("_hn")).filter("host is not null")
    domains = total("domain").select("domain", F.col("s").alias("_ds"), F.col("n").alias("_dn")).filter("domain is not null")
    joined = salted_join(alone, likelihood("declared"), ["declared"], uid, "left")
    joined = salted_join(joined, likelihood("suffix"), ["suffix"], uid, "left")
    joined = salted_join(joined, hosts.join(domains, "domain"), ["domain", "host"], uid, "left", grows=True)

    def prior(i: int) -> Column:
        own = F.col("p")[i]
        base = (everything[i] - own + 1.0) / (rows - 1.0 + size)
        domain = F.when(F.col("_dn").isNull(), base).otherwise((F.col("_ds")[i] - own + PRIOR_WEIGHT * base) / (F.col("_dn") - 1 + PRIOR_WEIGHT))
        host = F.when(F.col("_hn").isNull(), domain).otherwise((F.col("_hs")[i] - own + PRIOR_WEIGHT * domain) / (F.col("_hn") - 1 + PRIOR_WEIGHT))
        # A difference of sums may fall below nought by rounding.
        return F.log(F.greatest(host, F.lit(1e-12)))

    def said(column: str, i: int) -> Column:
        return F.coalesce(F.col(f"_{column}")[i], F.lit(0.0))

    scores = F.array(*[F.col("likelihoods")[i] + said("declared", i) + said("suffix", i) + prior(i) for i in range(size)])
    names = F.array(*[F.lit(x) for x in languages])
    best = F.array_max(F.zip_with("_scores", F.sequence(F.lit(0), F.lit(size - 1)), lambda s, i: F.struct(s.alias("s"), (-i).alias("i"))))
    text_best = F.array_position("likelihoods", F.array_max("likelihoods")).cast("int")
    result = joined.withColumn("_scores", scores).withColumn("_best", best)
    mass = F.aggregate("_scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_best.s")))
    return result.select(
        *[c for c in evidence.columns if c != "likelihoods"],
        F.element_at(names, (-F.col("_best.i") + 1).cast("int")).alias("language"),
        (1 / mass).alias("confidence"),
        F.when(F.col("grams") > 0, F.element_at(names, text_best)).alias("text_language"),
    )


def page_languages(pages: DataFrame, model: TextModel) -> DataFrame:
    """Language of every page of a table with page_id, url and html."""
    declared = F.regexp_extract("html", r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-zA-Z]+)""", 1)
    rows = pages.select(
        "page_id", "html", F.when(declared != "", F.lower(declared)).alias("declared"), *[c.alias(n) for n, c in address_parts(F.col("url")).items()]
    )
    return fused(with_likelihoods(rows, model, "html", markup=True), model.languages, "page_id")


def document_languages(docs: DataFrame, model: TextModel) -> DataFrame:
    """Language of every document of a table with doc_id, text, lang and source; the source serves as host."""
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "text",
        F.lower("lang").alias("declared"),
        F.col("source").alias("host"),
        F.col("source").alias("domain"),
        F.lit(None).cast("string").alias("suffix"),
    )
    return fused(with_likelihoods(rows, model, "text", markup=False), model.languages, "doc_id")
