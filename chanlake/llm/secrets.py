"""Secret scans: candidates by pattern, false positives removed by a random forest.

A forest of Spark's own library looks at a candidate's length, how its characters follow
each other, how much of it are dictionary words, whether it is part of a path, and the words
beside it. It is trained from labelled findings. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlake.session import materialised

# What a candidate is, and words that tell beside one.
CANDIDATE = r"""(?<=[=:] {0,2}["'])[^\s"']{8,}|(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}={0,2}"""
CREDENTIAL = r"(?i)token|secret|passw(or)?d|passphrase|api.?key|access.?key|private.?key|credential|bearer|auth"
HARMLESS = r"(?i)example|sample|dummy|placeholder|commit|checksum|digest|version|uuid|order|invoice|card"
ASSIGNED = r"(?i)(token|secret|passw(or)?d|api.?key|access.?key|private.?key)\W{0,4}[=:] {0,2}[\"']?$"
BEFORE, AFTER = 48, 24  # characters beside a candidate that are looked at
MIN_WORD, MIN_COUNT = 3, 3  # a dictionary word's letters and occurrences

FEATURES = (
    "length", "transitions", "unlike_words", "digits", "upper", "distinct", "covered", "slashes",
    "in_path", "assigned", "quoted", "credential_near", "harmless_near",
)


@dataclass
class Forest:
    """``model`` is None if the labelled findings were of one kind only, which is ``only``."""

    model: RandomForestClassificationModel | None
    only: float | None
    transitions: DataFrame
    dictionary: DataFrame


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, occurrence, value, before, after``; occurrence counts from 0 in a text.

    Texts are split at the candidates, so what stands between two of them is seen by both.
    """
    values = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    found = docs.select("doc_id", "text", values.alias("_values")).filter(F.size("_values") > 0)
    found = found.withColumn("_gaps", F.split("text", CANDIDATE, -1))
    zipped = F.arrays_zip("_values", "_gaps", F.slice("_gaps", F.lit(2), F.size("_gaps")).alias("_next"))
    found = found.select("doc_id", F.posexplode(zipped).alias("occurrence", "_z"))
    return found.filter(F.col("_z._values").isNotNull()).select(
        "doc_id",
        "occurrence",
        F.col("_z._values").alias("value"),
        F.right(F.col("_z._gaps"), F.lit(BEFORE)).alias("before"),
        F.left(F.col("_z._next"), F.lit(AFTER)).alias("after"),
    )


def rule_labels(found: DataFrame) -> DataFrame:
    """Labelled findings by rule, where none were made by hand: ``doc_id, occurrence,
    is_secret``. A value of letters and digits that is assigned to a credential's name is
    one; a value of digits alone, or beside a harmless word, is none. Others stay open."""
    mixed = F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]")
    label = F.when(F.col("before").rlike(ASSIGNED) & mixed, 1).when(
        ~F.col("value").rlike("[A-Za-z]") | F.concat("before", "after").rlike(HARMLESS), 0
    )
    return found.select("doc_id", "occurrence", label.alias("is_secret")).filter("is_secret IS NOT NULL")


def dictionary(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``word``: letter runs of the candidates that the texts use as words, from a count of
    the words of all texts."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
    often = words.filter(F.length("word") >= MIN_WORD).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT).select("word")
    return often.join(found.select(F.explode(_parts()).alias("word")).distinct(), "word", "left_semi")


def _parts() -> Column:
    return F.regexp_extract_all(F.lower("value"), F.lit(rf"[a-z]{{{MIN_WORD},}}"), F.lit(0))


def _pairs(found: DataFrame) -> DataFrame:
    """Each two characters in a row; digits are alike, as are other characters."""
    shape = F.regexp_replace(F.regexp_replace(F.lower("value"), "[0-9]", "9"), "[^a-z9]", "#")
    places = F.sequence(F.lit(1), F.length(shape) - 1)
    return found.filter(F.length("value") > 1).select("doc_id", "occurrence", F.explode(F.transform(places, lambda i: F.substring(shape, i, F.lit(2)))).alias("pair"))


def transition_ratios(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``pair, ratio``: how much likelier a pair is in secrets; at most 28 * 28 rows."""
    labelled = _pairs(found).join(labels, ["doc_id", "occurrence"])
    counts = labelled.groupBy("pair").agg(
        F.sum("is_secret").alias("_s"), F.sum(1 - F.col("is_secret")).alias("_o")
    )
    share = lambda n: (F.col(n) + 1) / (F.sum(n).over(Window.partitionBy()) + 28 * 28)
    return counts.select("pair", F.log(share("_s") / share("_o")).alias("ratio"))


def with_features(found: DataFrame, transitions: DataFrame, words: DataFrame) -> DataFrame:
    """Every candidate with the FEATURES as doubles."""
    ids = ["doc_id", "occurrence"]
    odd = _pairs(found).join(F.broadcast(transitions), "pair").groupBy(*ids).agg(F.avg("ratio").alias("unlike_words"))
    known = (
        found.select(*ids, F.explode(_parts()).alias("word"))
        .join(words, "word")
        .groupBy(*ids)
        .agg(F.sum(F.length("word")).alias("_covered"))
    )
    value, before = F.col("value"), F.col("before")
    length = F.length(value)
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    runs = count("[a-z]+") + count("[A-Z]+") + count("[0-9]+") + count("[^a-zA-Z0-9]+")
    beside = F.concat_ws(" ", before, "after")
    flags = {
        "length": length,
        "transitions": (runs - 1) / length,
        "digits": count("[0-9]") / length,
        "upper": count("[A-Z]") / length,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / length,
        "slashes": count("/"),
        "in_path": before.rlike(r"[/\\.@]$|https?:\S*$") | F.col("after").rlike(r"^[/\\@]|^\.\w"),
        "assigned": before.rlike(r"[=:] {0,2}[\"']?$"),
        "quoted": before.rlike("[\"']$"),
        "credential_near": beside.rlike(CREDENTIAL),
        "harmless_near": beside.rlike(HARMLESS),
    }
    joined = found.join(odd, ids, "left").join(known, ids, "left")
    flags["unlike_words"] = F.coalesce("unlike_words", F.lit(0.0))
    flags["covered"] = F.coalesce(F.col("_covered") / length, F.lit(0.0))
    return joined.withColumns({k: v.cast("double") for k, v in flags.items()}).drop("_covered")


def train(docs: DataFrame, found: DataFrame, labels: DataFrame, trees: int = 32, depth: int = 6) -> Forest:
    """Fit the forest on ``labels(doc_id, occurrence, is_secret)``.

    Null labels and ids are left out; of repeated labels the largest counts. Trees differ by the
    features they may use, not by rows, so reruns agree. Without labels nothing is removed.
    """
    labels = (
        labels.filter("doc_id IS NOT NULL AND occurrence IS NOT NULL AND is_secret IS NOT NULL")
        .groupBy("doc_id", "occurrence")
        .agg(F.max(F.col("is_secret").cast("int")).alias("is_secret"))
    )
    transitions = materialised(transition_ratios(found, labels), "transitions")
    words = materialised(dictionary(docs, found), "dictionary")
    marked = with_features(found, transitions, words).join(labels, ["doc_id", "occurrence"])
    rows = materialised(marked.select(F.col("is_secret").cast("double").alias("label"), *FEATURES), "labelled")
    low, high = rows.agg(F.min("label"), F.max("label")).first()
    if low is None or low == high:
        return Forest(None, 1.0 if low is None else low, transitions, words)
    classifier = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=7, bootstrap=False, featureSubsetStrategy="sqrt", maxMemoryInMB=64
    )
    model = classifier.fit(_assembled(rows))
    return Forest(model, None, transitions, words)


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def classify(found: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id, occurrence, value, probability, is_secret`` of every candidate."""
    rows = with_features(found, forest.transitions, forest.dictionary)
    if forest.model is None:
        scored = rows.withColumn("probability", F.lit(forest.only))
    else:
        scored = forest.model.transform(_assembled(rows)).withColumn(
            "_p", F.element_at(vector_to_array("probability"), 2)
        ).drop("probability").withColumnRenamed("_p", "probability")
    return scored.select("doc_id", "occurrence", "value", "probability", (F.col("probability") >= 0.5).alias("is_secret"))


def scan(docs: DataFrame, labels: DataFrame | None = None, learn_from: Column | None = None) -> DataFrame:
    """Findings of all texts of ``docs(doc_id, text)`` with the forest's verdict.

    ``labels`` default to ``rule_labels``; ``learn_from`` says which rows of ``docs`` may be
    learned from (default all). Texts that are null or hold no candidate give no row; rows
    without an id are not scanned; rows with the same id and text count once, with the same
    id and other texts they are one document with repeated occurrences.
    """
    own = docs.filter("doc_id IS NOT NULL")
    extra = {"_learn": learn_from if learn_from is not None else F.lit(True)}
    learned = own.withColumns(extra).filter("_learn").select("doc_id").distinct()
    found = materialised(candidates(own.select("doc_id", "text")).distinct(), "candidates")
    if labels is None:
        labels = rule_labels(found)
    forest = train(own, found, labels.join(learned, "doc_id", "left_semi"))
    return classify(found, forest)
