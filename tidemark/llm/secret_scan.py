"""Secret scanning with a random forest that sorts out false positives.

Candidates are words with a digit and of some length and, whatever their digits
and length, words in a form of issued keys, words assigned to or following a
telling name, lines that begin or end a private key, and the words of its
block. Their features: length,
transitions between character classes and their log-probability under the
corpus's own letter pairs, the share of letters that dictionary words cover,
the path (here the source) and the words beside them. The forest is trained on
labelled findings, a frame of candidates with label 0 or 1; where none is
given, ``rule_labels`` labels candidates by their form and by the name they are
assigned to. At most ``TRAIN_ROWS`` distinct findings of each label, those with
the smallest hashes, are used for training, weighted so that labels keep the
shares they have among all labelled findings; those of paths are of all, too.

The dictionary and the letter pairs come from the words of all documents. The
features of a candidate string are computed once, however often it occurs.
Everything is DataFrame and Spark ML code. Null and empty texts have no
candidates; with findings of one label only, that label is the score, and with
none the score is 0. Rows with equal ids are scanned separately.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, smallest_hashes, text_of, written

LEAST_LENGTH = 8
DICTIONARY_COUNT = 5
TRAIN_ROWS = 10_000
TREES = 20
DEPTH = 6
# Names that secrets are assigned to, and forms of issued keys.
NAMES = ["password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "access_key", "auth", "bearer", "credential"]
ISSUED = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abp]-[0-9A-Za-z-]{10,}|sk-[0-9A-Za-z]{20,})$"
ISSUED_STARTS = ["AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xoxa-", "xoxb-", "xoxp-", "sk-"]
# A telling name at the end of its words, and marks that assign.
NAME = r"(?i)(?:" + "|".join(NAMES) + r")s?(?:[_-]\w+)*[\"']?"
ASSIGNS = r"[=:]+>?"
OPENED, CLOSED = r"""["'(<\[{]*""", r"""["')>\],.;:!?}]"""
OWN_VALUE = NAME + ASSIGNS + OPENED + r"""[^\s=:"'(<\[{)>\],.;!?}]"""
KEY_LINE = r"PRIVATE KEY(?: BLOCK)?-----"
KEY_BLOCK = r"(?s)PRIVATE KEY(?: BLOCK)?-----(.*?)(?:-----END|\z)"
# Values that stand for none.
PLACEHOLDERS = r"(?i)^(?:null|none|nil|true|false|undefined|required|optional|string|str|x+|\*+|\.+|[<$%{].*)$"
FIXTURE_PATHS = r"(?i)(test|example|sample|fixture|mock|doc)"
FEATURES = [
    "length", "digits", "uppers", "lowers", "marks", "distinct_chars", "changes", "pair_log", "coverage",
    "path_length", "path_fixture", "path_rate", "named", "assigned", "quoted", "before_named", "after_length",
]


def candidates(docs: DataFrame) -> DataFrame:
    """Candidates of a table with doc_id, text and source, with the words beside them."""
    w = F.split(text_of(), SPACE)
    none = F.lit("")
    beside = F.arrays_zip(
        F.concat(F.array(none, none), w).alias("before2"),
        F.concat(F.array(none), w).alias("before"),
        w.alias("word"),
        F.concat(F.slice(w, 2, F.size(w)), F.array(none)).alias("after"),
    )
    # What a document has at all, found once, spares its words the dearer tests.
    lower = F.lower("text")
    has = {
        "_names": F.greatest(*[F.contains(lower, F.lit(n)) for n in NAMES]),
        "_issued": F.greatest(*[F.contains("text", F.lit(k)) for k in ISSUED_STARTS]),
        "_keys": F.contains("text", F.lit("PRIVATE KEY")) | F.col("text").rlike(r"PRIVATE\s+KEY"),
    }
    marked = docs.select("doc_id", "text", "source", *[F.coalesce(c, F.lit(False)).alias(k) for k, c in has.items()])
    block = F.when(F.col("_keys"), F.split(F.array_join(F.regexp_extract_all(F.regexp_replace("text", SPACE, " "), F.lit(KEY_BLOCK), 1), " "), " "))
    rows = marked.filter(F.col("_names") | F.col("_issued") | F.col("_keys") | F.col("text").rlike("[0-9]")).select(
        "doc_id", F.col("source").alias("path"), *has, block.alias("_block"), F.posexplode(beside).alias("position", "z")
    )
    word = F.col("z.word")
    secret = F.when(F.col("_keys") & word.rlike(r"^(?:KEY|BLOCK)-----[^A-Za-z0-9]*$"), F.lit("PRIVATE KEY-----")).otherwise(secret_part(word))
    key_line = word.rlike("^(?:KEY|BLOCK)-----") & F.concat_ws(" ", "z.before2", "z.before", word).rlike(KEY_LINE)
    in_block = F.array_contains("_block", word)
    follows = F.col("z.before").rlike(NAME + r"(?:[=:]+>?)?$") | (
        F.col("z.before").rlike(r"^(?:[=:]+>?|is|was)$") & F.col("z.before2").rlike(NAME + "$")
    )
    wanted = (
        ((F.length(word) >= LEAST_LENGTH) & word.rlike("[0-9]"))
        | (F.col("_issued") & secret_part(word).rlike(ISSUED))
        | (F.col("_names") & (word.rlike(OWN_VALUE) | (follows & secret_part(word).rlike(r"[^\s=:>]"))))
        | (F.col("_keys") & (key_line | (in_block & word.rlike("[A-Za-z0-9]"))))
    )
    return rows.filter(wanted).select("doc_id", "path", "position", "z.word", "z.before2", "z.before", "z.after", secret.alias("secret"))


def secret_part(word: Column) -> Column:
    """What is assigned, without name, quotes and closing marks."""
    # The last telling name of a word, else the name it begins with; padding at the end of a value is no assignment.
    value = F.when(word.rlike(OWN_VALUE), F.regexp_replace(word, "^.*" + NAME + ASSIGNS + "(?=" + OPENED + r"""[^\s=:"'(<\[{)>\],.;!?}])""", ""))
    value = value.otherwise(F.regexp_replace(word, r"""^[A-Za-z_][A-Za-z_0-9]*\s*[=:]+(?!["')>\],.;:!?}=]*$)""", ""))
    return F.regexp_replace(value, f"^{OPENED[:-1]}+|{CLOSED}+$", "")


def rule_labels(found: DataFrame) -> DataFrame:
    """Candidates with a label: 1 for issued forms, lines of private keys and what is assigned to a telling name, else 0."""
    context = F.lower(F.concat_ws(" ", "before2", "before", "word"))
    named = context.rlike("(" + "|".join(NAMES) + r")[\"']?\s*[=:]")
    random = F.col("secret").rlike("[0-9].*[0-9].*[0-9]") & (F.length("secret") >= 12)
    own = F.col("word").rlike(OWN_VALUE)
    after_name = F.col("before").rlike(NAME + ASSIGNS + "$") | (F.col("before").rlike(f"^{ASSIGNS}$") & F.col("before2").rlike(NAME + "$"))
    # After a colon and without quotes, a plain word is prose.
    prose = F.col("secret").rlike("^[A-Za-z]?[a-z]*$") & ~F.col("before").rlike("=>?$") & ~F.col("word").rlike("^[\"']")
    assigned = (own | (after_name & ~prose)) & ~F.col("secret").rlike(PLACEHOLDERS)
    key = F.col("secret") == "PRIVATE KEY-----"
    issued = F.col("secret").rlike(ISSUED)
    return found.withColumn("label", F.when(issued | key | (named & random) | assigned, 1.0).otherwise(0.0))


def vocabulary(docs: DataFrame) -> DataFrame:
    """Words of letters and how many times they occur in all texts."""
    words = docs.select(F.explode(F.split(F.lower(text_of()), r"[^\p{L}]+")).alias("entry"))
    return words.filter(F.length("entry") >= 2).groupBy("entry").agg(F.count("*").alias("n"))


def letter_pairs(words: DataFrame) -> DataFrame:
    """Log-probability of a letter after another, from the distinct words; a pair not seen has none."""
    pairs = (
        words.filter("entry rlike '^[a-z]+$'")
        .select(F.explode(F.transform(F.sequence(F.lit(1), F.length("entry") - 1), lambda i: F.col("entry").substr(i, F.lit(2)))).alias("pair"))
        .groupBy("pair")
        .agg(F.count("*").alias("n"))
    )
    first = Window.partitionBy(F.substring("pair", 1, 1))
    return pairs.select("pair", F.log((F.col("n") + 1) / (F.sum("n").over(first) + 26)).alias("pair_log"))


UNSEEN_PAIR = -8.0


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with its features; those of the string itself are computed once per string."""
    strings = found.select("secret").distinct()
    chunks = strings.select("secret", F.explode(F.split(F.lower("secret"), r"[^\p{L}]+")).alias("entry")).filter(F.length("entry") >= 2)
    known = words.filter(F.col("n") >= DICTIONARY_COUNT).select("entry", F.lit(1).alias("_known"))
    covered = chunks.join(known, "entry", "left").groupBy("secret").agg(
        F.sum(F.when(F.col("_known") == 1, F.length("entry")).otherwise(0)).alias("_covered")
    )
    pairs = strings.filter(F.length("secret") > 1).select(
        "secret", F.explode(F.transform(F.sequence(F.lit(1), F.length("secret") - 1), lambda i: F.lower("secret").substr(i, F.lit(2)))).alias("pair")
    )
    logs = pairs.join(letter_pairs(words), "pair", "left").groupBy("secret").agg(F.avg(F.coalesce("pair_log", F.lit(UNSEEN_PAIR))).alias("pair_log"))
    size = F.greatest(F.length("secret"), F.lit(1))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace("secret", f"[^{pattern}]", "")) / size

    classes = F.col("secret")
    for kind, letter in (("[^a-zA-Z0-9]", "#"), ("[0-9]", "9"), ("[a-z]", "a"), ("[A-Z]", "b")):
        classes = F.regexp_replace(classes, kind, letter)
    own = (
        strings.join(covered, "secret", "left")
        .join(logs, "secret", "left")
        .select(
            "secret",
            F.length("secret").cast("double").alias("length"),
            share("0-9").alias("digits"),
            share("A-Z").alias("uppers"),
            share("a-z").alias("lowers"),
            (1 - share("a-zA-Z0-9")).alias("marks"),
            (F.size(F.array_distinct(F.split("secret", ""))) / size).alias("distinct_chars"),
            ((F.length(F.regexp_replace(classes, r"(.)\1*", "x")) - 1) / size).alias("changes"),
            F.coalesce("pair_log", F.lit(UNSEEN_PAIR)).alias("pair_log"),
            (F.coalesce("_covered", F.lit(0)) / size).alias("coverage"),
        )
    )
    return found.join(own, "secret")


def context_features(found: DataFrame) -> DataFrame:
    """Features of the path and the words beside a candidate."""
    names = "(?i)(" + "|".join(NAMES) + ")"

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    return found.withColumns(
        {
            "path_length": F.coalesce(F.length("path"), F.lit(0)).cast("double"),
            "path_fixture": flag(F.col("path").rlike(FIXTURE_PATHS)),
            "named": flag(F.col("word").rlike(names)),
            "assigned": flag(F.col("word").rlike("[=:]") | F.col("before").rlike("[=:]$")),
            "quoted": flag(F.col("word").rlike("[\"']")),
            "before_named": flag(F.concat_ws(" ", "before2", "before").rlike(names)),
            "after_length": F.length("after").cast("double"),
        }
    )


def training_rows(labelled: DataFrame) -> DataFrame:
    """Distinct strings per label, bounded in number."""
    counts = labelled.select("secret", "label").distinct().groupBy("label").agg(F.count("*").alias("_rows"))
    return smallest_hashes(labelled.dropDuplicates(["secret", "label"]), counts, "label", "secret", TRAIN_ROWS)


def scan(docs: DataFrame, findings: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """Every candidate with its score; ``findings`` has secret and label (default: the rule's labels)."""
    words = written(vocabulary(docs).filter(F.col("n") >= 2), "secret-words")
    found = written(rule_labels(candidates(docs)), "secret-candidates")
    full = written(context_features(features(found, words)), "secret-features")
    labelled = full if findings is None else full.drop("label").join(findings.select("secret", "label").distinct(), "secret")
    # How often a path's labelled findings were secrets, smoothed towards the overall share.
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    share = float(sum(label * n for label, n in sizes.items()) / max(1, sum(sizes.values())))
    rates = written(
        labelled.groupBy("path").agg(((F.sum("label") + 10 * share) / (F.count("*") + 10)).alias("path_rate")), "secret-paths"
    )
    train = written(training_rows(labelled), "secret-training")
    taken = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}

    def with_rate(rows: DataFrame) -> DataFrame:
        small = rates.filter(F.col("path").isNotNull())
        return rows.join(small, "path", "left").withColumn("path_rate", F.coalesce("path_rate", F.lit(share)))

    keep = ["doc_id", "position", "secret", "label"]
    if len(sizes) < 2:
        return full.select(*keep, F.lit(share).alias("score"))
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featuresCol="features", labelCol="label", weightCol="weight")
    # Few, sorted rows: the same forest on every run.
    weight = F.element_at(F.create_map(*[F.lit(float(x)) for label, n in sizes.items() for x in (label, n / taken[label])]), F.col("label").cast("double"))
    ordered = with_rate(train).withColumn("weight", weight).repartition(4, "secret").sortWithinPartitions("secret", "label")
    model = forest.fit(assemble.transform(ordered))
    scored = model.transform(assemble.transform(with_rate(full)))
    return scored.select(*keep, F.element_at(vector_to_array("probability"), 2).alias("score"))
