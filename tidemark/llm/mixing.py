"""Mix sources to target weights by blocks of words.

A source's texts, one after another, are cut into blocks of a fixed number of
words. The mix is a row of block slots, dealt to output shards. How many slots
of each source a shard gets is a multinomial draw conditioned on the sources'
totals (a draw without replacement from the urn of all slots), so that every
source meets its target exactly. A source's slots run through its blocks in
passes, each pass in the order of a pseudorandom permutation of its own, and
slots meet blocks in a join on the block's index.

Everything is column expressions. Nulls: a null text has no words and a null
source is a source, the last one. Rows with equal ids are separate documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, count_words, running_total, salted_join, single_rows, spread, text_of, written

BLOCK_WORDS = 256
SHARD_BLOCKS = 1024
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
ROUNDS = 24
SLOTS_A_ROW = 4096


@dataclass
class Mix:
    """``documents``: one row each, with its place in its source's stream; ``sources``: targets and slots;
    ``slots``: shard, place, source and block of every slot; ``pieces``: documents' parts of the blocks."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame

    def shard_counts(self) -> DataFrame:
        """Slots of each source in each output shard."""
        return self.slots.groupBy("shard", "source_no").agg(F.count("*").alias("slots"))

    def takes(self) -> DataFrame:
        """Every part of a document that a slot takes: source, stream start of the document, pass, offset, words."""
        used = F.least(F.col("offset") + F.col("length"), F.col("used")) - F.col("offset")
        return (
            self.slots.join(self.pieces, ["source_no", "block"])
            .withColumn("words", used)
            .filter("words > 0")
            .select("source_no", "start", "pass", "from_word", "words", "shard", "place")
        )


def permuted(number: Column, size: Column, *seed: Column) -> Column:
    """Where a permutation of 0 to size - 1, fixed by the seed, puts a number (swap-or-not shuffle)."""

    def turn(now: Column, step: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*seed, step), size) + size - now, size)
        swap = F.xxhash64(*seed, step, F.greatest(now, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(now)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), number.cast("long"), turn)


def with_targets(sources: DataFrame) -> DataFrame:
    """Source sizes with weights by code-point order (null last) and targets.

    The targets share the sum of all sizes by weight. One above its limit is
    set to it and the excess shared again by weight, which ends at one level
    for all others: the water level over sources sorted by limit per weight.
    """
    everything = Window.partitionBy(F.lit(0))
    rising = everything.orderBy("_limit_a_weight", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = sources.withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1
    ).withColumn("weight", F.element_at(weights, (F.col("source_no") % len(WEIGHTS) + 1).cast("int")))
    total = F.sum("source_size").over(everything).cast("double")
    limit = (F.col("source_size") * MOST_REPEATS).cast("double")
    level = (total - F.coalesce(F.sum("_limit").over(rising), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))
    )
    capped = (
        ranked.withColumn("_limit", limit)
        .withColumn("_limit_a_weight", F.col("_limit") / F.col("weight"))
        .withColumn("_level", level)
        .withColumn("_capped", F.col("_limit_a_weight") <= F.col("_level"))
    )
    shared = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything)
    target = F.when(F.col("_capped"), F.col("_limit")).otherwise(F.col("weight") * shared)
    return capped.withColumn("target", target).drop("_limit", "_limit_a_weight", "_level", "_capped")


def mix(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 1,
) -> Mix:
    """Plan the mix of a table with doc_id, text and source."""
    sized = written(
        docs.select(
            "doc_id", "source", count_words(text_of()).alias("size"), F.xxhash64("text").alias("text_hash")
        ),
        "mix-sizes",
    )
    rows = sized.count()
    streamed = running_total(sized, ["source", "doc_id", "text_hash"], "size", "at", "mix-streams", rows)
    totals = streamed.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("at").alias("_base"))
    full = F.floor(F.col("source_size") / block_words)
    take = F.least(F.round("target").cast("long"), F.col("source_size") * MOST_REPEATS)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("take") / F.col("source_size"))).otherwise(F.lit(0))
    in_order = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    sources = written(
        with_targets(totals)
        .withColumn("take", take)
        .withColumn("full", full)
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words))
        .withColumn("passes", passes)
        .withColumn("rest", F.col("take") - F.col("passes") * F.col("source_size"))
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words))
        .withColumn("first_slot", F.coalesce(F.sum("slots").over(in_order), F.lit(0)))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy(F.lit(0)))),
        "mix-sources",
    )
    named = sources.select("source_no", "_base", "source_size", "target", F.coalesce("source", F.lit("")).alias("_name"), F.col("source").isNull().alias("_no_name"))
    documents = written(
        salted_join(
            streamed.withColumn("_name", F.coalesce("source", F.lit(""))).withColumn("_no_name", F.col("source").isNull()),
            named,
            ["_name", "_no_name"],
            F.col("at"),
        ).select("doc_id", "size", "text_hash", "source_no", "source_size", "target", (F.col("at") - F.col("_base")).alias("start")),
        "mix-documents",
        rows,
    )
    return Mix(documents, sources, _slots(sources, block_words, shard_blocks, seed), _pieces(documents, block_words))


def _slots(sources: DataFrame, block_words: int, shard_blocks: int, seed: int) -> DataFrame:
    """Every slot of the mix: its shard and place, its source, its pass and block, and the words it uses."""
    rows = sources.filter("slots > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / SLOTS_A_ROW))).alias("_row")
    )
    last = F.least(F.col("slots"), (F.col("_row") + 1) * SLOTS_A_ROW) - 1
    total = sources.agg(F.sum("slots")).first()[0] or 0
    numbered = rows.repartition(spread(total, 8 * SLOTS_A_ROW), "source_no", "_row").select(
        "*", F.explode(F.sequence(F.col("_row") * SLOTS_A_ROW, last)).alias("slot")
    )
    number = F.col("first_slot") + F.col("slot")
    ordered = permuted(F.col("_at"), F.greatest(F.col("full"), F.lit(1)), F.lit(seed), F.col("source_no"), F.col("pass"))
    words = F.when(F.col("block") < F.col("full"), F.lit(block_words)).otherwise(F.col("source_size") - F.col("full") * block_words)
    left = F.when(F.col("pass") < F.col("passes"), words).otherwise(F.least(words, F.col("rest") - F.col("_at") * block_words))
    # Stored, so that the join that follows knows how many slots there are.
    return written(
        numbered.withColumn("_drawn", permuted(number, F.col("all_slots"), F.lit(seed)))
        .withColumn("shard", F.floor(F.col("_drawn") / shard_blocks))
        .withColumn("place", F.col("_drawn") % shard_blocks)
        .withColumn("pass", F.floor(F.col("slot") / F.col("blocks")))
        .withColumn("_at", F.col("slot") % F.col("blocks"))
        .withColumn("block", F.when(F.col("_at") < F.col("full"), ordered).otherwise(F.col("_at")))
        .withColumn("used", left)
        .select("shard", "place", "source_no", "pass", "block", "used"),
        "mix-slots",
    )


def _pieces(documents: DataFrame, block_words: int) -> DataFrame:
    """The parts of each document that lie in one block: from_word in the document, offset in the block."""
    end = F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))
    begins = F.greatest(F.col("start"), F.col("block") * block_words)
    return (
        documents.filter("size > 0")
        .select("source_no", "start", "size", F.explode(blocks).alias("block"))
        .withColumn("from_word", begins - F.col("start"))
        .withColumn("offset", begins - F.col("block") * block_words)
        .withColumn("length", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - begins)
        .select("source_no", "block", "start", "from_word", "offset", "length")
    )


def taken_words(mixed: Mix) -> DataFrame:
    """One row per document: how many of its words the mix takes, repeats counted."""
    taken = mixed.takes().groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
    # Documents without words share a start with the next one and take nothing.
    sized = mixed.documents.withColumn("_start", F.when(F.col("size") > 0, F.col("start")))
    return sized.join(
        taken.withColumnRenamed("start", "_start"), ["source_no", "_start"], "left"
    ).withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mix as documents: one row per document and pass, holding the words that the pass takes.

    A pass that takes a whole document keeps its text as it is; a part keeps
    its words, joined by one space.
    """
    takes = (
        mixed.takes()
        .groupBy("source_no", "start", "pass")
        .agg(F.array_sort(F.collect_list(F.struct("from_word", "words"))).alias("_parts"), F.sum("words").alias("_words"))
    )
    plan = takes.join(mixed.documents.filter("size > 0"), ["source_no", "start"]).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__plan"), F.col("_parts").alias("__parts"), F.col("_words").alias("__words"), F.col("size").alias("__size")
    )
    rows = single_rows(docs, mixed.documents)
    joined = rows.join(plan, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__plan")))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    part = F.array_join(
        F.flatten(F.transform("__parts", lambda p: F.slice(words, (p["from_word"] + 1).cast("int"), p["words"].cast("int")))), " "
    )
    joined = joined.withColumn("text", F.when(F.col("__words") == F.col("__size"), F.col("text")).otherwise(part))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)
