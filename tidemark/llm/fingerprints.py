"""Document fingerprints by consistent weighted sampling.

A document is its words, in lower case, with their counts as weights. For each
sample number, every word has two gamma variates and one uniform variate that
depend on nothing but word and number; they turn the word's weight into a step
and a value, and the document's sample is the word and step of least value. Two
documents agree on a sample with a probability equal to their generalised
Jaccard similarity (sum of least counts by sum of largest).

Everything is column expressions. The order of documents is found by buckets of
neighbouring ids: texts are shuffled once, by bucket, and each bucket receives
the last document of the one before it, so that no task holds more than a
bucket in order.

A null text is empty. Documents without words have an empty fingerprint; two
such are alike (1), one such and another are not (0). Equal ids are separate
documents in the order of their texts' hashes; null ids come before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, text_of, written

SAMPLES = 32
BUCKET_ROWS = 512
INTERVALS = 64
WIDE = 1 << 24


def sample(bits: Column, log_weight: Column) -> Column:
    """A word's value (high bits) and the hash of word and step (low 32 bits), as one number to take the least of.

    ``bits`` is the hash of word and sample number.
    """

    def uniform(first: int, count: int) -> Column:
        part = F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << count) - 1))
        return (part.cast("double") + 0.5) / float(1 << count)

    rate = -F.log(uniform(0, 13) * uniform(13, 13))
    value = F.log(-F.log(uniform(26, 13) * uniform(39, 13)))
    shift = uniform(52, 12)
    step = F.floor(log_weight / rate + shift)
    least = ((value - rate * (step - shift + 1.0) + 64.0) * float(WIDE)).cast("long")
    name = bits.bitwiseXOR(F.shiftrightunsigned(bits, 31)).bitwiseXOR(F.shiftleft(step.cast("long"), 7)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(least, 32).bitwiseOR(name)


def buckets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with its bucket, rising with doc_id, and per bucket the last id of the bucket before it.

    Bounds are approximate quantiles of the ids, of which there is a fixed
    number; within two bounds, buckets have equal width.
    """
    ids = docs.select("doc_id")
    few = [i / INTERVALS for i in range(INTERVALS + 1)]
    found = ids.agg(F.count("doc_id").alias("n"), F.percentile_approx("doc_id", few, 10000).alias("q")).first()
    bounds = sorted(set(found["q"] or [0]))
    each = max(1, round(found["n"] / max(1, len(bounds)) / BUCKET_ROWS))
    steps = [max(1, -(-(b - a) // each)) for a, b in zip(bounds, bounds[1:], strict=False)] + [1 << 62]

    def number(doc_id: Column) -> Column:
        low = F.array(*[F.lit(b).cast("long") for b in bounds])
        interval = F.greatest(F.size(F.filter(low, lambda b: b <= doc_id)) - 1, F.lit(0))
        width = F.element_at(F.array(*[F.lit(s).cast("long") for s in steps]), interval + 1)
        inside = F.greatest(F.floor((doc_id - F.element_at(low, interval + 1)) / width), F.lit(0))
        place = interval.cast("long") * (each + 1) + F.least(inside, F.lit(each))
        return F.when(doc_id.isNull(), F.lit(-1).cast("long")).otherwise(place)

    numbered = docs.withColumn("bucket", number(F.col("doc_id")))
    last = ids.withColumn("bucket", number(F.col("doc_id"))).groupBy("bucket").agg(F.max("doc_id").alias("_last"))
    order = Window.orderBy("bucket")
    everything = Window.partitionBy(F.lit(0))
    edges = written(
        last.select(
            "bucket",
            F.coalesce(F.lag("_last").over(order), F.when(F.row_number().over(order) == 1, F.max("_last").over(everything))).alias("edge_id"),
        ),
        "fingerprint-edges",
    )
    return numbered, edges


def in_order(docs: DataFrame) -> DataFrame:
    """Texts by bucket and number, with the next document's text (descending ids); copies of a bucket's next stand first."""
    plain = docs.select("doc_id", text_of().alias("text"))
    own, edges = buckets(plain)
    edge = plain.withColumnRenamed("doc_id", "_id").join(edges, F.col("_id").eqNullSafe(F.col("edge_id")))
    rows = own.withColumn("guest", F.lit(0)).unionByName(
        edge.select(F.col("_id").alias("doc_id"), "text", "bucket", F.lit(1).alias("guest"))
    )
    order = Window.partitionBy("bucket").orderBy(F.col("guest").desc(), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n - cut)"), F.expr("substring(next_text, 1, cut)"))
    return (
        rows.withColumn("number", F.row_number().over(order))
        .withColumn("next_text", F.coalesce(F.lag("text").over(order), F.lit("")))
        .withColumn("n", size)
        .withColumn("cut", cut)
        .withColumn("edited", edited)
        .select("bucket", "number", "guest", "doc_id", F.col("n").cast("long").alias("n_chars"), "text", "edited")
    )


def facts(rows: DataFrame) -> tuple[list[str], list[Column]]:
    """What is kept of a document besides its samples, as names and numbers."""
    digest = F.sha2("edited", 256)
    quarters = [F.conv(F.substring(digest, 1 + 16 * k, 16), 16, -10).cast("long") for k in range(4)]
    return ["doc_id", "n_chars", "guest", "sha0", "sha1", "sha2", "sha3"], [F.col("doc_id"), F.col("n_chars"), F.col("guest").cast("long"), *quarters]


def signatures(rows: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Of rows keyed by bucket and number: facts, and the samples of the texts and the edited texts as arrays.

    Words carry odd numbers. The facts travel as words of their own with even
    numbers, so that the texts need not be shuffled for them a second time.
    """
    names, values = facts(rows)
    said = F.concat_ws(" ", *[F.concat(F.lit(f"{2 * k}:"), v.cast("string")) for k, v in enumerate(values)])
    three = F.array(
        F.struct(F.col("text").alias("t"), F.lit(1).alias("own"), F.lit(0).alias("edit")),
        F.struct(F.col("edited").alias("t"), F.lit(0).alias("own"), F.lit(1).alias("edit")),
        F.struct(said.alias("t"), F.lit(0).alias("own"), F.lit(0).alias("edit")),
    )
    words = (
        rows.select("bucket", "number", F.explode(three).alias("v"))
        .select("bucket", "number", "v.own", "v.edit", F.explode(F.split(F.lower("v.t"), SPACE)).alias("word"))
        .filter("word != ''")
    )
    fact = (F.col("own") + F.col("edit")) == 0
    term = F.when(fact, F.substring_index("word", ":", 1).cast("long")).otherwise(F.xxhash64("word").bitwiseOR(F.lit(1)))
    own = F.when(fact, F.substring_index("word", ":", -1).cast("long")).otherwise(F.col("own").cast("long"))
    terms = words.groupBy("bucket", "number", term.alias("term")).agg(F.sum(own).alias("own"), F.sum("edit").alias("edit"))

    def on(side: int, weight: str) -> Column:
        return F.struct(F.lit(side).alias("side"), F.col(weight).alias("weight"))

    # A word of equal weight in both texts (side 3) is sampled once for both; sides 1 and 2 are one text's alone.
    is_word = F.col("term").bitwiseAND(F.lit(1)) == 1
    sides = (
        F.when(~is_word, F.array(on(0, "own")))
        .when(F.col("own") == F.col("edit"), F.array(on(3, "own")))
        .when(F.col("edit") == 0, F.array(on(1, "own")))
        .when(F.col("own") == 0, F.array(on(2, "edit")))
        .otherwise(F.array(on(1, "own"), on(2, "edit")))
    )
    weighted = terms.select("bucket", "number", "term", F.explode(sides).alias("s")).select(
        "bucket",
        "number",
        "term",
        "s.side",
        "s.weight",
        F.log("s.weight").alias("log_weight"),
        *[F.xxhash64("term", F.lit(j)).alias(f"h{j}") for j in range(samples)],
    )
    kept = [F.max(F.when(F.col("term") == 2 * k, F.col("weight"))).alias(name) for k, name in enumerate(names)]
    least = [F.min(sample(F.col(f"h{j}"), F.col("log_weight"))).alias(f"m{j}") for j in range(samples)]
    by_side = weighted.groupBy("bucket", "number", "side").agg(*kept, *least)
    of_text = [
        F.min(F.when(F.col("side").bitwiseAND(F.lit(bit)) > 0, F.col(f"m{j}"))).alias(f"{text}{j}")
        for text, bit in (("a", 1), ("b", 2))
        for j in range(samples)
    ]
    low = F.lit(0xFFFFFFFF)
    found = by_side.groupBy("bucket", "number").agg(*[F.max(name).alias(name) for name in names], *of_text)
    return found.select(
        "bucket",
        "number",
        *names,
        *[
            F.when(F.col(f"{side}0").isNotNull(), F.array(*[F.col(f"{side}{j}").bitwiseAND(low) for j in range(samples)])).alias(name)
            for side, name in (("a", "signature"), ("b", "edited_signature"))
        ],
    )


def as_text(signature: Column) -> Column:
    """A signature as eight hexadecimal digits a sample; empty without words."""
    digits = F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 8, "0")))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of samples on which two signatures agree."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda s: s)) / samples
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how like they and the next document's are."""
    order = Window.partitionBy("bucket").orderBy("number")
    digest = F.concat(*[F.lower(F.lpad(F.hex(f"sha{k}"), 16, "0")) for k in range(4)])
    return (
        signatures(in_order(docs), samples)
        .withColumn("_next", F.lag("signature").over(order))
        .filter("guest = 0")
        .select(
            "doc_id",
            "n_chars",
            digest.alias("edited_sha256"),
            as_text(F.col("signature")).alias("fingerprint"),
            as_text(F.col("edited_signature")).alias("edited_fingerprint"),
            likeness(F.col("signature"), F.col("edited_signature"), samples).alias("near_edited"),
            likeness(F.col("signature"), F.col("_next"), samples).alias("near_next"),
        )
    )
