"""Mixing sources to target weights as a curriculum that changes over the training run.

A source's schedule says how its share of the stream changes with time. Its integral is the
source's cumulative demand for tokens; inverting it tells when the token with a given place
in the source's own order is wanted, and documents are range-sorted by that time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlake.llm.ranges import digest, range_count, running_total

GAP = r"[\x20\x09-\x0D]+"
STEPS = 1_000_000  # training positions are given in millionths of the run


@dataclass(frozen=True)
class Recipe:
    """``weights`` go to the sources in code point order, null last, over and over.

    ``budget``: words of the mix as a multiple of all words. ``repeats``: the most times a
    source is taken. ``ramps``: for each weight the rate at the start and the end of training,
    relative to the source's mean rate; it changes linearly between them.
    """

    weights: tuple[float, ...] = (5, 2, 1)
    budget: float = 1.5
    repeats: float = 2.0
    ramps: tuple[tuple[float, float], ...] = ((0.5, 1.5), (1.0, 1.0), (1.5, 0.5))

    def __post_init__(self):
        if min(self.weights) <= 0 or self.budget < 0 or self.repeats < 0:
            raise ValueError("weights have to be positive, budget and repeats not negative")
        if len(self.ramps) != len(self.weights) or any(min(r) < 0 or sum(r) != 2 for r in self.ramps):
            raise ValueError("a ramp for each weight, not negative, with a mean of 1")


def word_count(text: str | Column) -> Column:
    """Words of a text; 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")).cast("bigint")


def source_targets(sizes: DataFrame, recipe: Recipe) -> DataFrame:
    """``source, source_size, target, weight_no`` from ``source, size``, a row for each document.

    The budget is shared by weight; a source stops at ``repeats`` times its size and the
    rest shares the excess, in closed form: sources in the order of their limit for each
    unit of weight are at their limit up to the first whose fair share is less. One row a
    source goes through one task, documents are added up before.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = len(recipe.weights)
    totals = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight_no", (F.row_number().over(by_name) - 1) % kinds)
        .withColumn("_place", F.row_number().over(by_name))
        .withColumn("_weight", _pick(recipe.weights, F.col("weight_no")))
        .withColumn("_limit", F.col("source_size") * F.lit(float(recipe.repeats)))
    )
    by_limit = Window.orderBy(F.col("_limit") / F.col("_weight"), "_place")
    everything = Window.partitionBy()
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    fair = (
        F.sum("source_size").over(everything) * F.lit(float(recipe.budget))
        - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    ) / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    free = F.when(F.col("_limit") > F.col("_fair") * F.col("_weight"), F.col("_fair"))
    shared = totals.withColumn("_fair", fair).withColumn("_unit", F.max(free).over(everything))
    target = F.least("_limit", F.coalesce(F.col("_unit") * F.col("_weight"), F.col("_limit")))
    return shared.select("source", "source_size", target.alias("target"), "weight_no")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (index + 1).cast("int"))


def time_of(share: Column, start: Column, end: Column) -> Column:
    """When a source with a linear ramp has given ``share`` of its words: the inverse of
    ``start * t + (end - start) * t * t / 2``, whose value at 1 is 1."""
    return F.lit(2.0) * share / (start + F.sqrt(start * start + F.lit(2.0) * (end - start) * share))


def curriculum(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """Every document with ``size, source_size, target, taken, steps``.

    Documents of a source stand in the order of a digest of ``doc_id`` (of the text without one), then
    of a digest of the text. A document is taken
    once for each time that the source is gone through, if its middle comes before the
    source's target, so the words taken differ from the target by half a document at most.
    ``steps``: the training positions of its copies, 0 to 999999; empty if it is not taken.
    Whole documents only; rows with equal ids are documents of their own. Null texts and
    texts without words have size 0; a source without words has target 0 and its documents
    are taken at step 0. Existing columns of the names added are replaced.
    """
    added = ["size", "source_size", "target", "taken", "steps"]
    docs = docs.drop(*added).withColumn("size", word_count("text"))
    own = F.when(F.col("doc_id").isNotNull(), digest("doc_id")).otherwise(digest("text"))
    docs = docs.withColumns({"_order": own, "_of_text": F.xxhash64("text")})
    targets = source_targets(docs.select("source", "size"), recipe).withColumnRenamed("source", "_source")
    ranges = range_count(docs.count())
    order = ["_order", "doc_id", "_of_text"]
    placed = running_total(docs, ["source"], order, F.col("size"), "_words_before", ranges)
    rows = placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    middles = [
        (F.lit(float(k)) * F.col("source_size") + F.col("_words_before")) + F.col("size") / F.lit(2.0)
        for k in range(-int(-recipe.repeats // 1))
    ]
    starts, ends = zip(*recipe.ramps, strict=True)
    start, end = _pick(starts, F.col("weight_no")), _pick(ends, F.col("weight_no"))

    def step(middle: Column) -> Column:
        share = F.least(middle / F.greatest("target", F.lit(1e-9)), F.lit(1.0))
        at = F.when(share > 0, time_of(share, start, end)).otherwise(F.lit(0.0))
        return F.least(F.floor(at * F.lit(float(STEPS))), F.lit(STEPS - 1)).cast("bigint")

    wanted = F.array(*(F.when(m <= F.col("target"), step(m)) for m in middles))
    rows = rows.withColumn("steps", F.array_compact(wanted))
    taken = F.col("size") * F.size("steps")
    return rows.withColumn("taken", taken.cast("bigint")).drop("_order", "_of_text", "_words_before", "weight_no")


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each copy of a taken document, range-sorted by its training position."""
    copies = mixed.withColumn("step", F.explode("steps")).drop("steps")
    order = ["step", digest("doc_id"), F.xxhash64("text")]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order)
