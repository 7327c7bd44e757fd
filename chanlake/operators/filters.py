"""Filters over messages and channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.functions.messages import has_comment_thread


def content_only(messages: DataFrame) -> DataFrame:
    """Content messages: the Message tag and not a comment stored the old way."""
    return messages.filter(_is_content())


def service_side(messages: DataFrame) -> DataFrame:
    """Everything ``content_only`` leaves out."""
    return messages.filter(~_is_content())


def split_content_service(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    return content_only(messages), service_side(messages)


def _is_content() -> Column:
    return F.coalesce(
        (F.col("_") == "Message") & F.col("comments_msg_id").isNull(), F.lit(False)
    )


def with_comment_thread(messages: DataFrame) -> DataFrame:
    """Messages whose comments can be fetched; works on raw and flat messages."""
    if "replies" in messages.columns:
        return messages.filter(has_comment_thread(F.col("replies")))
    return messages.filter((F.col("nr_replies") > 0) & F.col("has_comments"))


def in_period(messages: DataFrame, start: Column, end: Column, date: str = "date") -> DataFrame:
    """Messages after ``start`` up to and including ``end``."""
    return messages.filter((F.col(date) > start) & (F.col(date) <= end))


def up_to(messages: DataFrame, end: Column, date: str = "date") -> DataFrame:
    return messages.filter(F.col(date) <= end)


def after_offset(
    messages: DataFrame, marks: DataFrame, keys: tuple[str, ...] = ("channel_id",)
) -> DataFrame:
    """Messages beyond their channel's high-water mark; all where there is none."""
    marked = messages.join(marks.withColumnRenamed("last_id", "_mark"), list(keys), "left")
    return marked.filter(F.col("id") > F.coalesce("_mark", F.lit(0))).drop("_mark")


def forwarded_from_channel(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("fwd_from.from_id.channel_id").isNotNull())


def explorable(channels: DataFrame, private_priority: int, priority: str = "priority") -> DataFrame:
    """Drops private channels; those put last for looking like spam stay."""
    return channels.filter(F.col(priority) < private_priority)


def not_in(df: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(others.select(*keys), keys, "left_anti")


def participants_visible(docs: DataFrame) -> DataFrame:
    return docs.filter(F.coalesce(F.col("full_chat.can_view_participants"), F.lit(False)))
