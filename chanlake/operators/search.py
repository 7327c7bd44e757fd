"""Searching messages by text and type, and channels by keyword."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlake.functions.text import matches_query

# Keywords, and bytes of them, up to which every task gets them all.
FEW_KEYWORDS, FEW_BYTES = 100_000, 4 << 20


def content_type(kind: str) -> Column:
    """Predicate of a content type over flat messages; ``message`` is any."""
    if kind == "message":
        return F.lit(True)
    if kind == "url":
        return F.coalesce(F.col("media_type") == "webpage", F.lit(False)) | (
            F.coalesce(F.size("text_urls"), F.lit(0)) > 0
        )
    if kind in ("gif", "music"):
        return F.coalesce(F.col("document_kind") == kind, F.lit(False))
    return F.coalesce(F.col("media_type") == kind, F.lit(False))


def search_messages(messages: DataFrame, query: str = "", kind: str = "message") -> DataFrame:
    """Messages holding the query, blind to case, of one content type."""
    return messages.filter(matches_query(F.col("message"), query) & content_type(kind))


def words(text: Column) -> Column:
    """Lower-case words of a text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def _digest(phrase: Column) -> Column:
    """128 bits of neighbouring words."""
    return F.unhex(F.md5(F.array_join(phrase, " ")))


def _phrases(tokens: Column, n: int) -> Column:
    """Digests of each ``n`` neighbouring words."""
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    digests = F.transform(starts, lambda at: _digest(F.slice(tokens, at, F.lit(n))))
    return F.when(F.size(tokens) >= n, digests).otherwise(F.array().cast("array<binary>"))


def search_channels(
    channels: DataFrame,
    keywords: DataFrame,
    text: Column,
    limit: int | None = None,
    order: list[Column] | None = None,
) -> DataFrame:
    """Each keyword with the channels that match it; only the first ``limit`` on request.

    A channel matches when the keyword's words stand in its text one after the other: an equality
    join on digests of as many neighbouring words as a keyword has. No text is copied for its words,
    and no pair is made that does not match. The numbers of words that keywords have are looked up
    first, with how many keywords there are: few go to every task, and many meet the phrases in a
    shuffle. Phrases are never broadcast, as Spark's estimate knows nothing of how many a text has.
    A cut to ``limit`` happens in every task before the shuffle.
    """
    phrase = words(F.col("keyword"))
    asked = keywords.select("keyword", F.size(phrase).alias("_n"), _digest(phrase).alias("_phrase")).filter("_n > 0").distinct()
    counts = asked.groupBy("_n").agg(F.count("*").alias("n"), F.sum(F.octet_length("keyword")).alias("bytes")).collect()
    lengths = sorted(row["_n"] for row in counts)
    few = sum(row["n"] for row in counts) <= FEW_KEYWORDS and sum(row["bytes"] for row in counts) <= FEW_BYTES
    order_columns = order or [F.col("id").asc()]
    tokens = channels.select("*", words(text).alias("_words"))
    phrases = F.flatten(F.array(*(_phrases(F.col("_words"), n) for n in lengths))) if lengths else F.array(F.lit(b""))
    indexed = tokens.select(*channels.columns, F.explode(F.array_distinct(phrases)).alias("_phrase"))
    found = indexed.join(F.broadcast(asked) if few else asked.hint("merge"), "_phrase")
    if limit is None:
        return found.select("keyword", *channels.columns)
    window = Window.partitionBy("keyword").orderBy(*order_columns)
    return (
        found.withColumn("_row", F.row_number().over(window))
        .filter(F.col("_row") <= limit)
        .select("keyword", *channels.columns)
    )


def pending_keywords(keywords: DataFrame, searched: DataFrame) -> DataFrame:
    return keywords.distinct().join(searched, "keyword", "left_anti")


def merge_seeds_last_wins(*sources: DataFrame) -> DataFrame:
    """``channel_id, access_hash`` from several sources; later ones override."""
    ranked = None
    for rank, source in enumerate(sources):
        rows = source.select("channel_id", "access_hash", F.lit(rank).alias("_rank"))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    return ranked.groupBy("channel_id").agg(
        F.max_by("access_hash", F.struct("_rank", "access_hash")).alias("access_hash")
    )


def comment_thread(messages: DataFrame) -> DataFrame:
    """Messages paired with the message they reply to in the same channel."""
    parents = messages.select(
        "channel_id",
        F.col("id").alias("replies_to_msg_id"),
        F.col("message").alias("parent_message"),
    )
    replies = messages.filter(
        F.col("replies_to_msg_id").isNotNull()
        & (F.col("replies_to_chan_id").isNull() | (F.col("replies_to_chan_id") == F.col("channel_id")))
    )
    return replies.join(parents, ["channel_id", "replies_to_msg_id"])
