"""Language of a text by character trigrams, trained and applied as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.session import materialised

SCALE = 1000  # log-probabilities are kept as whole thousandths, so sums are exact
MARGIN = 20  # least lead per trigram, in thousandths, for a conclusive answer


def normalised(text: Column) -> Column:
    """Lower-case letters, words set apart by single blanks."""
    letters = F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")
    return F.concat(F.lit(" "), F.trim(letters), F.lit(" "))


def trigrams(text: Column) -> Column:
    """All overlapping trigrams of the whole text, in one pass over it."""
    return F.regexp_extract_all(normalised(text), F.lit("(?s)(?=(...))"), F.lit(1))


def train_profiles(labelled: DataFrame) -> DataFrame:
    """``trigram, language, weight`` rows from texts with a known ``language``.

    Weights are add-one smoothed log-probabilities over all trigrams of each language. The row with a null trigram holds the weight of any other trigram.
    """
    counts = (
        labelled.select("language", F.explode(trigrams(F.col("text"))).alias("trigram"))
        .groupBy("language", "trigram")
        .agg(F.count("*").alias("n"))
    )
    # The texts are read once: all that follows works on the counts.
    counts = materialised(counts, "trigram-counts")
    totals = counts.groupBy("language").agg((F.sum("n") + F.count("*")).alias("total"))

    def weight(count: Column) -> Column:
        return F.round(F.log((count + 1) / F.col("total")) * SCALE).cast("bigint")

    seen = counts.join(totals, "language").select(
        "trigram", "language", weight(F.col("n")).alias("weight")
    )
    unseen = totals.select(
        F.lit(None).cast("string").alias("trigram"), "language", weight(F.lit(0)).alias("weight")
    )
    # Written, so that the plans that use it know its size.
    return materialised(seen.unionByName(unseen), "profiles")


def _wide(profiles: DataFrame, languages: list[str]) -> DataFrame:
    """One row per trigram with a weight per language, gaps filled with the floor."""

    def of(language: str) -> Column:
        return F.max(F.when(F.col("language") == language, F.col("weight")))

    floor = profiles.filter(F.col("trigram").isNull()).agg(*(of(x).alias(x) for x in languages))
    pivoted = (
        profiles.filter(F.col("trigram").isNotNull())
        .groupBy("trigram")
        .agg(*(of(x).alias(x) for x in languages))
    )
    return pivoted.select(
        "trigram", *(F.coalesce(x, floor.select(x).scalar()).alias(x) for x in languages)
    )


def detect_language(
    texts: DataFrame,
    profiles: DataFrame,
    languages: list[str],
    keys: list[str],
    margin: int = MARGIN,
) -> DataFrame:
    """``keys, language``: the best scoring language, null if its lead is too small.

    Trigrams are scored by a join with the profile. Where Spark finds the profile small it
    broadcasts it, and sums per text are what moves; a large one is joined by shuffles. Trigrams that no profile knows say nothing; a text
    without any known one is inconclusive.
    """
    wide = _wide(profiles, languages)
    # The outer explode and join keep texts without (known) trigrams: no second look at them.
    found = texts.select(*keys, F.explode_outer(trigrams(F.col("text"))).alias("trigram"))
    sums = (
        found.join(wide, "trigram", "left")
        .groupBy(*keys)
        .agg(F.count(languages[0]).alias("_n"), *(F.sum(x).alias(x) for x in languages))
    )
    scores = F.array(
        *(F.struct(F.col(x).alias("score"), F.lit(x).alias("language")) for x in languages)
    )
    ranked = sums.select(*keys, "_n", F.sort_array(scores, asc=False).alias("_ranked"))
    second = F.coalesce(F.get("_ranked", 1)["score"], F.lit(0))
    lead = F.col("_ranked")[0]["score"] - second
    conclusive = (F.col("_n") > 0) & (lead >= F.col("_n") * margin)
    return ranked.select(
        *keys, F.when(conclusive, F.upper(F.col("_ranked")[0]["language"])).alias("language")
    )
