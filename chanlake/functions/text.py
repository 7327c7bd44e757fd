"""Text expressions: cleaning, channel text, user names, numeric ids, queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match exactly the same spans everywhere (fixed values). The
# prefix makes word classes and boundaries Unicode-aware.
HANDLE_OR_TAG = r"(?:^|\B)[@#]\w+(?:$|\b)"
LINK = r"(?:https?://|www\.|t\.me/)\S+"
UNICODE_CLASSES = "(?U)"
BOT_USERNAME = "@([a-zA-Z0-9_]+)"
BOT_RESULT_MARK = "result"
BOT_QUOTA_MARK = "exhausted your daily free searches"


def clean_text(text: Column) -> Column:
    """Text without @handles, #tags and links."""
    return F.regexp_replace(text, f"{UNICODE_CLASSES}(?:{HANDLE_OR_TAG})|(?:{LINK})", "")


def channel_text(title: Column, about: Column) -> Column:
    """Title and description in one text; a null part reads as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.coalesce(about, F.lit("")))


def extract_usernames(reply: Column) -> Column:
    """User names in a search bot's reply; null unless it is a result list."""
    return F.when(
        reply.contains(BOT_RESULT_MARK), F.regexp_extract_all(reply, F.lit(BOT_USERNAME), F.lit(1))
    )


def quota_exhausted(reply: Column) -> Column:
    return ~reply.contains(BOT_RESULT_MARK) & reply.contains(BOT_QUOTA_MARK)


def is_numeric_id(value: Column) -> Column:
    return F.coalesce(value.rlike("^[0-9]+$"), F.lit(False))


def numeric_id(value: Column) -> Column:
    """A digit-only id as a number, null for user names."""
    return F.when(is_numeric_id(value), value.cast("bigint"))


def matches_query(text: Column, query: str | Column) -> Column:
    """Case-blind containment; an empty query matches every non-null text."""
    needle = F.lower(F.lit(query) if isinstance(query, str) else query)
    return F.contains(F.lower(text), needle)
