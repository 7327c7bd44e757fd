"""Nested documents to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.functions import messages as M
from chanlake.functions.nested import matching_chat, other_chats
from chanlake.schemas import (
    CHANNELS,
    CHAT_ONLY,
    CONTENT_TYPES,
    FULL_ONLY,
    MESSAGES,
    SERVICE_MESSAGES,
    SHARED,
    USERS,
)
from chanlake.sources.tables import to_schema

EMPTY_LOCATION = "ChannelLocationEmpty"


def _keys(df: DataFrame, keep: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(c for c in keep if c in df.columns)


def flatten_messages(
    messages: DataFrame, keep: tuple[str, ...] = ("channel_id", "period", "file_modified")
) -> DataFrame:
    """The 39 table columns, after those of ``keep`` that exist. One projection."""
    media, forward, reply = F.col("media"), F.col("fwd_from"), F.col("reply_to")
    derived = {
        "media_type": M.media_type(media),
        "media_id": M.media_id(media),
        **{
            f"webpage_preview_{field}": M.webpage_preview(media, field)
            for field in ("url", "type", "site_name", "title", "description")
        },
        "from_type": M.peer_type(F.col("from_id")),
        "from_id": M.peer_id(F.col("from_id")),
        "replies_to_msg_id": reply["reply_to_msg_id"],
        "replies_to_chan_id": reply["reply_to_peer_id"]["channel_id"],
        "fwd_from_date": forward["date"],
        "fwd_from_msg_id": forward["channel_post"],
        "fwd_from_type": M.peer_type(forward["from_id"]),
        "fwd_from_id": M.peer_id(forward["from_id"]),
        "nr_replies": M.nr_replies(F.col("replies")),
        "has_comments": M.has_comments(F.col("replies")),
        "reactions": M.reactions_map(F.col("reactions")),
    }
    have = set(messages.columns)
    return messages.select(
        *_keys(messages, keep),
        *(
            derived.get(name, F.col(name) if name in have else F.lit(None))
            .cast(kind)
            .alias(name)
            for name, kind in MESSAGES.items()
        ),
    )


def flatten_service(
    messages: DataFrame, keep: tuple[str, ...] = ("channel_id", "period", "file_modified")
) -> DataFrame:
    """The service side: the action's tag, the rest of the action as JSON text, and all
    columns of a message, which comments stored the old way fill."""
    action = F.struct(
        M.action_type(F.col("action")).alias("action_type"), M.action_body(F.col("action")).alias("action")
    )
    rows = flatten_messages(messages.withColumn("_service", action), (*keep, "_service"))
    rows = rows.select("*", "_service.action_type", "_service.action")
    return to_schema(rows, SERVICE_MESSAGES, _keys(messages, keep))


def without_matching_chat(docs: DataFrame) -> DataFrame:
    """Documents that ``flatten_channels`` cannot use."""
    return docs.filter(matching_chat(F.col("chats"), F.col("full_chat.id")).isNull())


def flatten_channels(docs: DataFrame) -> DataFrame:
    """One row per channel document: its own chat merged with the full half.

    Where both halves have a key the full half wins, even with a null. The sticker set
    id is kept.
    """
    rows = docs.withColumn("_chat", matching_chat(F.col("chats"), F.col("full_chat.id")))
    rows = rows.filter(F.col("_chat").isNotNull())
    chat, full = F.col("_chat"), F.col("full_chat")
    no_names = F.array().cast("array<string>")

    def merged(name: str) -> Column:
        chosen = F.coalesce(full[name], chat[name])
        if "full_keys" in docs.columns:
            given = F.coalesce(F.array_contains("full_keys", name), F.lit(False))
            chosen = F.when(given, full[name]).otherwise(chat[name])
        return chosen

    location = full["location"]
    located = location.isNotNull() & (location["_"] != EMPTY_LOCATION)
    point = location["geo_point"]
    has_point = located & point["long"].isNotNull() & point["lat"].isNotNull()
    columns = {
        "id": full["id"],
        **{name: chat[name] for name in CHAT_ONLY},
        **{name: full[name] for name in FULL_ONLY},
        **{name: merged(name) for name in SHARED},
        "usernames": F.coalesce(
            F.transform(chat["usernames"], lambda u: u["username"]), no_names
        ),
        "date": F.try_to_timestamp(chat["date"]),
        "migrated_to": chat["migrated_to"]["channel_id"],
        "bot_ids": F.coalesce(
            F.transform(full["bot_info"], lambda b: b["user_id"]),
            F.array().cast("array<bigint>"),
        ),
        "linked_chats_ids": other_chats(F.col("chats"), full["id"]),
        "forwards_from": F.col("forwards_from"),
        "recommended_channels": F.col("recommended_channels"),
        "location_point": F.when(has_point, F.array(point["long"], point["lat"])),
        "location_str": F.when(located, location["address"]),
        "last_queried_at": _timestamp(docs, "last_queried_at"),
        "sticker_set_id": full["stickerset"]["id"],
        **{f"{kind}_count": F.col(f"{kind}_count") for kind in CONTENT_TYPES},
    }
    return rows.select(*(columns[name].cast(kind).alias(name) for name, kind in CHANNELS.items()))


def _timestamp(docs: DataFrame, name: str) -> Column:
    is_text = docs.schema[name].dataType.simpleString() == "string"
    return F.try_to_timestamp(F.col(name)) if is_text else F.col(name)


def flatten_users(docs: DataFrame) -> DataFrame:
    """Participants, one row each, without personal and display-only fields."""
    people = docs.select(
        F.col("full_chat.id").alias("channel_id"), F.explode("participants").alias("_user")
    )
    return people.select(
        "channel_id",
        *(F.col(f"_user.{name}").cast(kind).alias(name) for name, kind in USERS.items()),
    )


def content_counts(messages: DataFrame) -> DataFrame:
    """Messages per channel by content type.

    Animations and music are told apart by an attribute of the raw document that the
    stored message does not keep: give it as a column ``document_kind`` (``gif`` or
    ``music``) to have them counted, else they are null.
    """
    kind = F.col("media_type")
    counts = {
        "document": F.count_if(kind == "document"),
        "message": F.count("*"),
        "photo": F.count_if(kind == "photo"),
        "url": F.count_if(
            (kind == "webpage") | (F.coalesce(F.size("text_urls"), F.lit(0)) > 0)
        ),
        "video": F.count_if(kind == "video"),
        "voice": F.count_if(kind == "voice"),
    }
    for name in ("gif", "music"):
        if "document_kind" in messages.columns:
            counts[name] = F.count_if(F.col("document_kind") == name)
        else:
            counts[name] = F.lit(None).cast("bigint")
    return messages.groupBy("channel_id").agg(
        *(counts[name].alias(f"{name}_count") for name in CONTENT_TYPES)
    )
