"""Access into nested documents: dotted paths, chats, access hashes, user names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(body: Callable[..., Column], *values: Column) -> Column:
    """``body`` over values computed once per row, however often it uses them."""
    bound = F.array(F.struct(*(v.alias(f"v{i}") for i, v in enumerate(values))))
    return F.get(F.transform(bound, lambda s: body(*(s[f"v{i}"] for i in range(len(values))))), 0)


def navigate_path(obj: Column, path: str) -> Column:
    """Follow a dotted path: a number indexes a list, ``key:value`` picks the first
    element whose key has that value (numbers match their text form), anything else
    is a field. A missing step gives null."""
    for part in path.split("."):
        if part.isdigit():
            obj = F.get(obj, int(part))
        elif ":" in part:
            key, value = part.split(":")
            obj = F.get(F.filter(obj, lambda d: _equals(d[key].cast("string"), value)), 0)
        else:
            obj = obj[part]
    return obj


def navigate_variant(doc: Column, path: str) -> Column:
    """``navigate_path`` on a variant document, whose shape the schema does not fix."""
    for part in path.split("."):
        if part.isdigit():
            obj_path = f"$[{part}]"
            doc = F.try_variant_get(doc, obj_path, "variant")
        elif ":" in part:
            key, value = part.split(":")
            items = F.try_variant_get(doc, "$", "array<variant>")
            doc = F.get(
                F.filter(
                    items, lambda d: _equals(F.try_variant_get(d, f"$.{key}", "string"), value)
                ),
                0,
            )
        else:
            doc = F.try_variant_get(doc, f"$.{part}", "variant")
    return doc


def _equals(text: Column, value: str) -> Column:
    same = text == value
    if value.isdigit():
        same = same | (text == str(int(value)))
    return F.coalesce(same, F.lit(False))


def matching_chat(chats: Column, channel_id: Column) -> Column:
    """The first chat with the given id, null if there is none."""
    return F.get(F.filter(chats, lambda c: c["id"] == channel_id), 0)


def other_chats(chats: Column, channel_id: Column) -> Column:
    """Ids of the chats a document lists besides its own."""
    return F.transform(F.filter(chats, lambda c: c["id"] != channel_id), lambda c: c["id"])


def usernames_of(chat: Column) -> Column:
    """The main user name, then the active further ones."""
    empty = F.array().cast("array<string>")
    main = F.array_compact(F.array(chat["username"]))
    active = F.transform(
        F.filter(chat["usernames"], lambda u: u["active"]), lambda u: u["username"]
    )
    return F.concat(F.coalesce(main, empty), F.coalesce(active, empty))


def access_hash_for_key(chat: Column, key_name: str | Column) -> Column:
    """The access hash usable with a key: its own, else the chat's unless another key has it."""
    key = F.lit(key_name) if isinstance(key_name, str) else key_name
    hashes = F.coalesce(chat["access_hashes"], F.create_map().cast("map<string,bigint>"))
    own = F.try_element_at(hashes, key)
    free = F.when(~F.array_contains(F.map_values(hashes), chat["access_hash"]), chat["access_hash"])
    # A stored zero counts as no hash.
    return F.coalesce(F.nullif(own, F.lit(0).cast("bigint")), free)


def register_access_hash(chat: Column, key_name: str) -> Column:
    """The chat with its access hash filed under ``key_name``, if neither is known yet."""
    hashes = F.coalesce(chat["access_hashes"], F.create_map().cast("map<string,bigint>"))
    unknown = ~F.map_contains_key(hashes, key_name) & ~F.coalesce(
        F.array_contains(F.map_values(hashes), chat["access_hash"]), F.lit(False)
    )
    added = F.map_concat(hashes, F.create_map(F.lit(key_name), chat["access_hash"]))
    return F.when(unknown, chat.withField("access_hashes", added)).otherwise(chat)
