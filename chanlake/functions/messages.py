"""Columns of the flat message table, from the nested raw message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chanlake.schemas import PEER_ID_FIELDS


def _is(media: Column, tag: str) -> Column:
    return media["_"] == f"MessageMedia{tag}"


def media_type(media: Column) -> Column:
    document = (
        F.when(media["video"], "video").when(media["voice"], "voice").otherwise("document")
    )
    return (
        F.when(media.isNull(), F.lit(None).cast("string"))
        .when(_is(media, "WebPage"), "webpage")
        .when(_is(media, "Photo"), "photo")
        .when(_is(media, "Document"), document)
        .otherwise("other")
    )


def media_id(media: Column) -> Column:
    return (
        F.when(_is(media, "WebPage"), media["webpage"]["id"])
        .when(_is(media, "Photo"), media["photo"]["id"])
        .when(_is(media, "Document"), media["document"]["id"])
    )


def webpage_preview(media: Column, field: str) -> Column:
    return F.when(_is(media, "WebPage"), media["webpage"][field])


def peer_type(peer: Column) -> Column:
    return peer["_"]


def peer_id(peer: Column) -> Column:
    """The id field that the peer's tag selects; null for a null peer."""
    return F.coalesce(
        *(F.when(peer["_"] == tag, peer[field]) for tag, field in PEER_ID_FIELDS.items())
    )


def peer_known(peer: Column) -> Column:
    return peer.isNull() | F.coalesce(peer["_"].isin(*PEER_ID_FIELDS), F.lit(False))


def nr_replies(replies: Column) -> Column:
    return F.coalesce(replies["replies"], F.lit(0).cast("bigint"))


def has_comments(replies: Column) -> Column:
    return F.when(replies.isNull(), F.lit(False)).otherwise(replies["comments"])


def has_comment_thread(replies: Column) -> Column:
    return F.coalesce((replies["replies"] > 0) & replies["comments"], F.lit(False))


def reactions_map(reactions: Column) -> Column:
    """Reaction key -> count; of equal keys the last count counts.

    No struct gives null, no or null results give an empty map. The key is the
    emoticon unless empty, then the document id as text, then the text ``None``.
    """
    results = F.coalesce(
        reactions["results"],
        F.array().cast(
            "array<struct<count:bigint,reaction:struct<emoticon:string,document_id:bigint>>>"
        ),
    )
    keys = F.transform(
        results,
        lambda r: F.coalesce(
            F.nullif(r["reaction"]["emoticon"], F.lit("")),
            r["reaction"]["document_id"].cast("string"),
            F.lit("None"),
        ),
    )
    counts = F.reverse(F.transform(results, lambda r: r["count"]))
    # Distinct keys in order of appearance, each with the count of its last entry: the
    # map then has no equal keys, whatever the session's policy for them.
    last_first = F.reverse(keys)
    distinct = F.array_distinct(keys)
    values = F.transform(
        distinct, lambda k: F.get(counts, (F.array_position(last_first, k) - 1).cast("int"))
    )
    return F.when(reactions.isNotNull(), F.map_from_arrays(distinct, values)).cast(
        "map<string,bigint>"
    )


def action_type(action: Column) -> Column:
    return F.get_json_object(action, "$._")


def action_body(action: Column) -> Column:
    """The action without its tag, as JSON text."""
    fields = F.from_json(action, "map<string,variant>")
    return F.to_json(F.map_filter(fields, lambda k, _: k != "_"))


def emptied_page(cached: Column) -> Column:
    """A cached page, as JSON text, with its bulky lists emptied; null stays null.

    Absent lists are added empty too: setting them does not depend on their presence.
    """
    fields = F.from_json(cached, "map<string,variant>")
    bulky = ("blocks", "photos", "documents")
    empty = F.create_map(*(c for name in bulky for c in (F.lit(name), F.parse_json(F.lit("[]")))))
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*bulky))
    return F.when(fields.isNotNull(), F.to_json(F.map_concat(kept, empty)))


def prune_cached_page(page: Column) -> Column:
    """A web page whose cached page has its bulky lists emptied; others unchanged.

    ``page`` is JSON text. Null or absent cached pages are left alone.
    """
    fields = F.from_json(page, "map<string,variant>")
    emptied = emptied_page(F.get_json_object(page, "$.cached_page"))
    rebuilt = F.map_concat(
        F.map_filter(fields, lambda k, _: k != "cached_page"),
        F.create_map(F.lit("cached_page"), F.parse_json(emptied)),
    )
    return F.when(emptied.isNull(), page).otherwise(F.to_json(rebuilt))
