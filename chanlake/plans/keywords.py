"""Keyword search rounds: what to search, and the merged seeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.functions.text import extract_usernames
from chanlake.operators.search import merge_seeds_last_wins, pending_keywords, search_channels
from chanlake.operators.word_index import WordIndex
from chanlake.sources.tables import write_version


@dataclass(frozen=True)
class SearchRound:
    seeds: DataFrame
    searched: DataFrame


def bot_seeds(replies: DataFrame, channels: DataFrame) -> DataFrame:
    """Channels named in search bot replies (``reply``), looked up by user name."""
    names = replies.select(F.explode(extract_usernames(F.col("reply"))).alias("username")).distinct()
    return names.join(channels, "username").select(
        F.col("id").alias("channel_id"), "access_hash"
    )


def search_round(
    keywords: DataFrame,
    searched: DataFrame,
    replies: DataFrame,
    channels: DataFrame,
    seeds: DataFrame,
    text: Column,
    index: WordIndex | None = None,
) -> SearchRound:
    """Search the pending keywords; found channels extend the seeds, later sources win.

    With an ``index`` the channels that are new to it or changed are taken in, and it is asked
    instead of all texts.
    """
    pending = pending_keywords(keywords, searched)
    if index is None:
        hits = search_channels(channels, pending, text)
    else:
        index.update(channels, text)
        found_ids = index.search(pending).select("id").distinct()
        hits = channels.withColumn("id", F.col("id").cast("string")).join(found_ids, "id", "left_semi")
    found = hits.select(F.col("id").alias("channel_id"), "access_hash")
    return SearchRound(
        seeds=merge_seeds_last_wins(seeds, bot_seeds(replies, channels), found),
        searched=searched.unionByName(pending).distinct(),
    )


def write_round(result: SearchRound, root: str, version: str) -> None:
    write_version(result.seeds, f"{root}/seeds", version)
    write_version(result.searched, f"{root}/searched_keywords", version)
