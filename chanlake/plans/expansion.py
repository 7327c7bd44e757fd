"""One exploration step: edges, scores, what to visit next and which months to fetch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.functions.dates import collection_cutoff
from chanlake.functions.text import channel_text, clean_text
from chanlake.operators import graph as G
from chanlake.operators.language import detect_language
from chanlake.operators.periods import expected_periods, missing_periods, resume_offsets
from chanlake.operators.pseudonyms import deanonymise
from chanlake.session import materialised
from chanlake.sources.paths import list_exists

# From ``id, text`` to ``id, language``, null where the language is in doubt.
Detector = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Expansion:
    visited: DataFrame
    frontier: DataFrame
    issues: DataFrame
    fetch: DataFrame
    unknown: DataFrame  # channels that cannot be scored: a counter or their date is missing


def trigram_detector(profiles: DataFrame, languages: list[str]) -> Detector:
    return lambda texts: detect_language(texts, profiles, languages, ["id"])


def score_nodes(
    docs: DataFrame,
    edges: DataFrame,
    anon_map: DataFrame | None,
    detector: Detector,
    now: Column,
) -> DataFrame:
    """``channel_id, has_doc, spam, language`` of all documents and all edge ends."""
    fields = G.matching_doc_fields(docs)
    if anon_map is not None:
        fields = deanonymise(fields, anon_map, "title")
    texts = fields.select("id", clean_text(channel_text(F.col("title"), F.col("about"))).alias("text"))
    language = detector(texts)
    spam = G.looks_like_spam(F.col("pts"), F.col("participants_count"), F.col("date"), now)
    known = fields.join(language, "id").select(
        F.col("id").alias("channel_id"), F.lit(True).alias("has_doc"), spam.alias("spam"), "language"
    )
    ends = edges.select(F.explode(F.array("src", "dst")).alias("channel_id")).distinct()
    private = ends.join(known, "channel_id", "left_anti").withColumn("has_doc", F.lit(False))
    return known.unionByName(private, allowMissingColumns=True)


def expand(
    docs: DataFrame,
    messages: DataFrame,
    seeds: DataFrame,
    processed: DataFrame,
    profiles: DataFrame | None,
    languages: list[str] | None,
    now: Column,
    anon_map: DataFrame | None = None,
    detector: Detector | None = None,
) -> Expansion:
    """From documents and flat messages (with ``channel_id, period``) to the next step.

    ``detector`` takes the place of the trigram profiles.
    """
    detector = detector or trigram_detector(profiles, languages)
    forwards = G.forward_pairs(messages).select(
        F.col("channel_id").alias("src"), F.col("source_id").alias("dst"), F.lit(G.FORWARD).alias("kind")
    )
    edges = materialised(G.channel_edges(docs).unionByName(forwards).distinct(), "edges")
    nodes = materialised(
        score_nodes(docs, edges, anon_map, detector, now), "nodes"
    )
    visited = G.snowball(edges, nodes, seeds)
    channels = G.matching_doc_fields(docs).select(F.col("id").alias("channel_id"), "date")
    saved = messages.select("channel_id", "period").distinct()
    fetch = missing_periods(expected_periods(channels, collection_cutoff(now)), saved)
    pairs = edges.filter(F.col("kind") != G.LINKED).select(
        F.col("src").alias("channel_id"), F.col("dst").alias("source_id")
    )
    return Expansion(
        visited=visited,
        frontier=G.minus_processed(visited, processed),
        issues=G.issue_table(pairs, channels.withColumnRenamed("channel_id", "id")),
        fetch=resume_offsets(fetch, messages),
        unknown=nodes.filter("has_doc AND spam IS NULL").select("channel_id"),
    )


def record_issues(issues: DataFrame, path: str) -> None:
    """Add the issues that the stored table lacks; a repeated step adds nothing."""
    pair = ["channel_id", "source_id"]
    rows = issues.dropDuplicates(pair)
    if list_exists(issues.sparkSession, path):
        rows = rows.join(issues.sparkSession.read.parquet(path).select(*pair), pair, "left_anti")
        rows = materialised(rows, "issues")
    rows.write.mode("append").parquet(path)
