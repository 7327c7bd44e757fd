"""A stored positional index of channel texts, asked by the rarest word of a phrase.

Three growing tables below one folder: ``postings`` (word, channel, version and the positions of
the word in that version's text), ``counts`` (how many texts of an update hold a word) and
``texts`` (which version of a channel is the current one). A text is never copied: what moves are
the postings of the words that are asked for.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.operators.search import words
from chanlake.session import stages
from chanlake.sources.paths import list_exists

POSTINGS = "word string, id string, version string, positions array<int>, part int"
COUNTS = "word string, texts bigint"
TEXTS = "id string, version string, number bigint, digest string"
PARTS = 64  # folders of the postings by word; a search reads those of its words


@dataclass(frozen=True)
class WordIndex:
    """Searches see whole updates only: an update's texts are entered last. One update at a time."""

    spark: SparkSession
    root: str

    def update(self, channels: DataFrame, text: Column, id: str = "id") -> int:
        """Take in the channels that are new or whose text is another one; gives how many.

        Rows without an id are left out; of several rows of a channel the largest text counts. A
        null or empty text is entered and matches nothing. What an update that died has left
        behind has no current version, and so it is never found.
        """
        rows = channels.select(F.col(id).cast("string").alias("id"), text.alias("text"))
        one = rows.filter("id IS NOT NULL").groupBy("id").agg(F.max("text").alias("text"))
        digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
        known = self.texts().select("id", F.col("digest").alias("_digest"))
        number = (self._read("texts", TEXTS).agg(F.max("number")).first()[0] or 0) + 1
        # No other update, also none that died, has this version.
        version = F.lit(uuid.uuid4().hex).alias("version")
        with stages(self.spark) as stage:
            fresh = stage(
                one.select("*", digest)
                .join(known, "id", "left")
                .filter(~F.col("digest").eqNullSafe(F.col("_digest")))
                .select("id", "text", "digest", version, F.lit(number).cast("bigint").alias("number")),
                "texts",
            )
            postings = stage(_postings(fresh), "postings")
            by_part = postings.hint("rebalance", "part").sortWithinPartitions("part", "word", "id")
            by_part.write.mode("append").partitionBy("part").parquet(f"{self.root}/postings")
            counts = postings.groupBy("word").agg(F.count("*").alias("texts"))
            counts.write.mode("append").parquet(f"{self.root}/counts")
            fresh.select("id", "version", "number", "digest").write.mode("append").parquet(f"{self.root}/texts")
            return fresh.count()

    def texts(self) -> DataFrame:
        """``id, version, digest`` of every channel's current text."""
        newest = F.max_by(F.struct("version", "digest"), "number").alias("_t")
        return self._read("texts", TEXTS).groupBy("id").agg(newest).select("id", "_t.*")

    def search(self, keywords: DataFrame) -> DataFrame:
        """``keyword, id`` of all channels whose text holds the keyword's words one after another.

        The postings of a keyword's rarest word say where it may begin. Every further word is
        looked up by word and channel, so a common word is many keys, and its postings are read
        but never joined as a whole. Keywords without a word match nothing.
        """
        phrases = keywords.select("keyword", words(F.col("keyword")).alias("phrase")).distinct()
        asked = phrases.select("keyword", "phrase", F.posexplode("phrase").alias("place", "word"))
        postings = self._postings_of(asked)
        rarest = (
            asked.join(self._counts_of(asked), "word", "left")
            .groupBy("keyword")
            .agg(F.min_by(F.struct("word", "place", "phrase"), F.struct("texts", "word", "place")).alias("_r"))
            .select("keyword", "_r.*")
        )
        start = F.explode(F.transform("positions", lambda p: p - F.col("place"))).alias("start")
        first = rarest.join(postings, "word").select("keyword", "id", "version", "phrase", "place", start)
        others = first.filter("size(phrase) > 1 AND start >= 0").select(
            "keyword", "id", "version", "start", F.size("phrase").alias("n_words"),
            F.col("place").alias("_first"), F.posexplode("phrase").alias("place", "word"),
        )
        found = others.filter("place <> _first").join(postings, ["word", "id", "version"])
        found = found.filter(F.array_contains("positions", F.col("start") + F.col("place")))
        whole = found.groupBy("keyword", "id", "version", "start", "n_words").agg(F.count("*").alias("_n"))
        hits = (
            whole.filter("_n = n_words - 1")
            .select("keyword", "id", "version")
            .unionByName(first.filter("size(phrase) = 1").select("keyword", "id", "version"))
            .distinct()
        )
        return hits.join(self.texts().select("id", "version"), ["id", "version"], "left_semi").select("keyword", "id")

    def _counts_of(self, asked: DataFrame) -> DataFrame:
        """How many texts hold a word, by all updates: an upper bound where texts were replaced."""
        own = self._read("counts", COUNTS).join(asked.select("word").distinct(), "word", "left_semi")
        return own.groupBy("word").agg(F.sum("texts").alias("texts"))

    def _postings_of(self, asked: DataFrame) -> DataFrame:
        """Postings of the asked words. Only their folders are read, of which there are few."""
        asked_words = asked.select("word", _part()).distinct()
        parts = [row.part for row in asked_words.select("part").distinct().collect()]  # PARTS at most
        own = self._read("postings", POSTINGS).filter(F.col("part").isin(parts))
        return own.join(asked_words.select("word"), "word", "left_semi").drop("part")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not list_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)


def _part() -> Column:
    return F.pmod(F.xxhash64("word"), F.lit(PARTS)).cast("int").alias("part")


def _postings(texts: DataFrame) -> DataFrame:
    """One row for each word of a text, with its positions."""
    placed = texts.select("id", "version", F.posexplode(words(F.col("text"))).alias("position", "word"))
    grouped = placed.groupBy("id", "version", "word").agg(
        F.array_sort(F.collect_list("position")).alias("positions")
    )
    return grouped.select("word", "id", "version", "positions", _part())
