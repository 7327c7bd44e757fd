"""Refreshing stored documents with newer ones without losing listed nested parts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.functions.nested import let
from chanlake.session import materialised

_OBJECT = "map<string,variant>"
_LIST = "array<variant>"
ANY = "*"


def _as_object(value: Column) -> Column:
    return F.when(_kind(value) == "OBJECT", value.cast(_OBJECT))


def _as_list(value: Column) -> Column:
    return F.when(_kind(value) == "ARRAY", value.cast(_LIST))


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, null for nothing (absent or a JSON null), else SCALAR."""
    shape = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(None).cast("string"))
        .when(shape.startswith("OBJECT"), "OBJECT")
        .when(shape.startswith("ARRAY"), "ARRAY")
        .otherwise("SCALAR")
    )


def _text(value: Column) -> Column:
    return F.to_json(value)


def _overlay(old: Column, new: Column) -> Column:
    """The keys of two objects, the new one's values winning."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def _merge_end(old: Column, new: Column, unique: bool) -> Column:
    """What stands at the end of a listed path."""

    def objects(a: Column, b: Column) -> Column:
        return F.to_variant_object(_overlay(a, b))

    def lists(a: Column, b: Column) -> Column:
        if unique:
            seen = F.transform(a, _text)
            b = F.filter(b, lambda v: ~F.array_contains(seen, _text(v)))
        return F.concat(a, b).cast("variant")

    def body(old: Column, new: Column, old_kind: Column, new_kind: Column) -> Column:
        return (
            F.when(new_kind.isNull(), old)
            .when(old_kind.isNull(), new)
            .when(
                old_kind != new_kind,
                F.raise_error(F.lit("types differ at a preserved path")).cast("variant"),
            )
            .when(new_kind == "OBJECT", let(objects, _as_object(old), _as_object(new)))
            .when(new_kind == "ARRAY", let(lists, _as_list(old), _as_list(new)))
            .otherwise(new)
        )

    return let(body, old, new, _kind(old), _kind(new))


def _merge_paths(old: Column, new: Column, paths: list[list[str]], unique: bool) -> Column:
    """``new`` with the parts of ``old`` that ``paths`` lead to merged in."""
    if [] in paths:
        return let(lambda o, n: _merge_end(o, n, unique), old, new)
    result = new
    for step in sorted({path[0] for path in paths}):
        rest = [path[1:] for path in paths if path[0] == step]
        merge = _merge_items if ":" in step else _merge_field

        def merged(o: Column, n: Column, merge=merge, step=step, rest=rest) -> Column:
            return merge(o, n, step, rest, unique)

        result = let(merged, old, result)
    return result


def _merge_items(
    old: Column, new: Column, step: str, rest: list[list[str]], unique: bool
) -> Column:
    """``step`` selects list elements by one of their fields."""
    key, wanted = step.split(":", 1)

    def ident(item: Column) -> Column:
        return F.try_variant_get(item, f"$.{key}", "string")

    def merge_item(item: Column, twin: Column) -> Column:
        meant = twin.isNotNull()
        if wanted != ANY:
            meant = meant & (ident(item) == wanted)
        return F.when(meant, _merge_paths(twin, item, rest, unique)).otherwise(item)

    def merge_lists(new: Column, old_items: Column, new_items: Column) -> Column:
        def one(item: Column) -> Column:
            same = F.filter(old_items, lambda o: ident(o) == ident(item))
            return let(merge_item, item, F.get(same, 0))

        both = old_items.isNotNull() & new_items.isNotNull()
        return F.when(both, F.transform(new_items, one).cast("variant")).otherwise(new)

    return let(merge_lists, new, _as_list(old), _as_list(new))


def _merge_field(
    old: Column, new: Column, step: str, rest: list[list[str]], unique: bool
) -> Column:
    """``step`` names a key of both objects."""

    def put(new: Column, new_map: Column, value: Column) -> Column:
        others = F.map_filter(new_map, lambda k, _: k != step)
        replaced = F.to_variant_object(F.map_concat(others, F.create_map(F.lit(step), value)))
        return F.when(value.isNull(), new).otherwise(replaced)

    def merge_maps(new: Column, old_map: Column, new_map: Column) -> Column:
        value = _merge_paths(
            F.try_element_at(old_map, F.lit(step)),
            F.try_element_at(new_map, F.lit(step)),
            rest,
            unique,
        )
        both = old_map.isNotNull() & new_map.isNotNull()
        return F.when(both, let(put, new, new_map, value)).otherwise(new)

    return let(merge_maps, new, _as_object(old), _as_object(new))


def refresh_document(
    old: Column, new: Column, paths: list[str] = (), list_entries_are_unique: bool = False
) -> Column:
    """A stored document overlaid by a newer one (both variants).

    Top-level keys of the new document win, also with a null; keys only the old one has
    stay. At the dotted ``paths`` old content is kept: objects are merged with new keys
    winning, lists are joined (without repeats on request), and a part the new document
    lacks comes from the old one. ``key:value`` selects a list element, ``key:*`` each.
    """

    def body(old: Column, new: Column) -> Column:
        overlaid = let(
            lambda a, b: F.to_variant_object(_overlay(a, b)), _as_object(old), _as_object(new)
        )
        steps = [p.split(".") for p in paths]
        if not steps:
            return overlaid
        return _merge_paths(old, overlaid, steps, list_entries_are_unique)

    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(let(body, old, new))


def _clash(old: Column, new: Column, paths: list[list[str]], at: str = "") -> Column:
    """The first path at which both documents hold something, of different types; else null."""
    if [] in paths:
        differ = lambda a, b: F.when(a != b, F.concat(a, F.lit(" and "), b, F.lit(f" at {at}")))
        return let(differ, _kind(old), _kind(new))
    found = []
    for step in sorted({path[0] for path in paths}):
        rest = [path[1:] for path in paths if path[0] == step]
        place = f"{at}.{step}" if at else step
        look = _clash_in_items if ":" in step else _clash_in_field
        found.append(look(old, new, step, rest, place))
    return F.coalesce(*found)


def _clash_in_items(old: Column, new: Column, step: str, rest: list[list[str]], at: str) -> Column:
    key, wanted = step.split(":", 1)

    def ident(item: Column) -> Column:
        return F.try_variant_get(item, f"$.{key}", "string")

    def lists(old_items: Column, new_items: Column) -> Column:
        def one(item: Column) -> Column:
            twin = F.get(F.filter(old_items, lambda o: ident(o) == ident(item)), 0)
            meant = F.lit(True) if wanted == ANY else ident(item) == wanted
            return F.when(meant, let(lambda o, n: _clash(o, n, rest, at), twin, item))

        return F.get(F.array_compact(F.transform(new_items, one)), 0)

    return let(lists, _as_list(old), _as_list(new))


def _clash_in_field(old: Column, new: Column, step: str, rest: list[list[str]], at: str) -> Column:
    def maps(old_map: Column, new_map: Column) -> Column:
        values = (F.try_element_at(m, F.lit(step)) for m in (old_map, new_map))
        return let(lambda o, n: _clash(o, n, rest, at), *values)

    return let(maps, _as_object(old), _as_object(new))


@dataclass(frozen=True)
class Refreshed:
    """``docs`` as ``refresh_channel_docs`` gives them; ``refused`` are newer documents that could
    not be merged, with a ``reason``: their channels keep the stored document, if there is one."""

    docs: DataFrame
    refused: DataFrame


def refresh_or_refuse(
    old: DataFrame,
    new: DataFrame,
    key: str = "channel_id",
    doc: str = "doc",
    paths: tuple[str, ...] = ("chats.id:*.access_hashes",),
    list_entries_are_unique: bool = False,
) -> Refreshed:
    """As ``refresh_channel_docs``, but a document that is no JSON object, or whose type differs
    from the stored one's at a preserved path, is set aside and does not end the job.

    A stored document that is no JSON object is replaced. The merge runs once: both results are
    projections of one stage, which lives as long as the block of ``scratch`` around it.
    """
    steps = [p.split(".") for p in paths]

    def parsed(df: DataFrame, name: str) -> DataFrame:
        value = F.try_parse_json(F.col(doc))
        return df.select(key, F.col(doc).alias(f"{name}_text"), F.when(_kind(value) == "OBJECT", value).alias(name))

    both = parsed(old, "_old").join(parsed(new, "_new"), key, "full")
    broken = F.col("_new_text").isNotNull() & F.col("_new").isNull()
    clash = _clash(F.col("_old"), F.col("_new"), steps) if steps else F.lit(None).cast("string")
    reason = F.when(broken, "not a JSON object").otherwise(clash)
    marked = both.withColumn("_reason", reason)
    merged = refresh_document(F.col("_old"), F.col("_new"), list(paths), list_entries_are_unique)
    kept = F.when(F.col("_reason").isNotNull(), F.col("_old")).otherwise(merged)
    stage = materialised(
        marked.select(key, F.to_json(kept).alias("_doc"), "_new_text", F.col("_reason").alias("reason")), "refreshed"
    )
    refused = stage.filter("reason IS NOT NULL").select(key, F.col("_new_text").alias(doc), "reason")
    return Refreshed(stage.filter("_doc IS NOT NULL").select(key, F.col("_doc").alias(doc)), refused)


def refresh_channel_docs(
    old: DataFrame,
    new: DataFrame,
    key: str = "channel_id",
    doc: str = "doc",
    paths: tuple[str, ...] = ("chats.id:*.access_hashes",),
    list_entries_are_unique: bool = False,
) -> DataFrame:
    """Old and new document tables (JSON text per channel) merged by channel."""
    left = old.select(key, F.parse_json(doc).alias("_old"))
    right = new.select(key, F.parse_json(doc).alias("_new"))
    merged = refresh_document(
        F.col("_old"), F.col("_new"), list(paths), list_entries_are_unique
    )
    return left.join(right, key, "full").select(key, F.to_json(merged).alias(doc))
