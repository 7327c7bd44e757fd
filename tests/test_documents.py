"""Refreshing documents and following paths."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from chanlake.functions.nested import navigate_path, navigate_variant
from chanlake.operators.documents import refresh_channel_docs, refresh_document, refresh_or_refuse
from tests.conftest import rows


def merge(spark, old, new, paths=(), unique=False):
    df = spark.createDataFrame(
        [(None if old is None else json.dumps(old), None if new is None else json.dumps(new))],
        "a string, b string",
    ).select(F.parse_json("a").alias("a"), F.parse_json("b").alias("b"))
    merged = refresh_document(F.col("a"), F.col("b"), list(paths), unique)
    return json.loads(df.select(F.to_json(merged)).first()[0])


def test_top_level_keys_of_the_new_document_win(spark):
    assert merge(spark, {"a": 1, "b": 2}, {"b": None, "c": 3}) == {"a": 1, "b": None, "c": 3}
    assert merge(spark, None, {"a": 1}) == {"a": 1}
    assert merge(spark, {"a": 1}, None) == {"a": 1}


def test_preserved_paths(spark):
    old = {"m": {"x": 1, "y": 2}, "l": [1, 2], "k": {"d": {"p": 1}}, "s": 5}
    new = {"m": {"y": 3, "z": 4}, "l": [2, 3], "k": {"d": {}, "e": 1}, "s": 6}
    got = merge(spark, old, new, ["m", "l", "k.d", "s"])
    assert got == {
        "m": {"x": 1, "y": 3, "z": 4},
        "l": [1, 2, 2, 3],
        "k": {"d": {"p": 1}, "e": 1},
        "s": 6,
    }
    assert merge(spark, old, new, ["l"], unique=True)["l"] == [1, 2, 3]
    assert merge(spark, {"m": {"x": 1}}, {"m": None}, ["m"]) == {"m": {"x": 1}}
    with pytest.raises(Exception, match="types differ"):
        merge(spark, {"m": {"x": 1}}, {"m": [1]}, ["m"])


def test_access_hashes_of_matched_chats_survive(spark):
    old = {
        "chats": [
            {"id": "p", "access_hashes": {"ann": 1, "bob": 2}},
            {"id": "q", "access_hashes": {"ann": 7}},
            {"id": "gone", "access_hashes": {"ann": 8}},
        ]
    }
    new = {
        "chats": [
            {"id": "q"},
            {"id": "p", "title": "t", "access_hashes": {"bob": 3}},
            {"id": "fresh"},
        ]
    }
    expected = {
        "chats": [
            {"id": "q", "access_hashes": {"ann": 7}},
            {"id": "p", "title": "t", "access_hashes": {"ann": 1, "bob": 3}},
            {"id": "fresh"},
        ]
    }
    assert merge(spark, old, new, ["chats.id:*.access_hashes"]) == expected
    only_p = merge(spark, old, new, ["chats.id:p.access_hashes"])
    assert only_p["chats"][0] == {"id": "q"} and only_p["chats"][1] == expected["chats"][1]


def test_document_tables(spark):
    old = spark.createDataFrame([("a", '{"x":1}'), ("b", '{"x":2}')], "channel_id string, doc string")
    new = spark.createDataFrame([("b", '{"y":3}'), ("c", '{"x":4}')], "channel_id string, doc string")
    got = {r.channel_id: json.loads(r.doc) for r in refresh_channel_docs(old, new).collect()}
    assert got == {"a": {"x": 1}, "b": {"x": 2, "y": 3}, "c": {"x": 4}}


def test_paths(spark):
    doc = {"a": [{"id": 7, "v": "x"}, {"id": 8, "v": "y"}], "b": {"c": ["p", "q"]}}
    df = spark.createDataFrame([(json.dumps(doc),)], "t string")
    typed = df.select(
        F.from_json("t", "a array<struct<id:long,v:string>>, b struct<c:array<string>>").alias("d")
    )
    free = df.select(F.parse_json("t").alias("d"))
    for path, value in {"a.1.v": "y", "a.id:7.v": "x", "a.id:007.v": "x", "b.c.0": "p", "b.c.9": None, "a.id:1.v": None}.items():
        assert typed.select(navigate_path(F.col("d"), path)).first()[0] == value
        found = F.try_variant_get(navigate_variant(F.col("d"), path), "$", "string")
        assert free.select(found).first()[0] == value


def test_clashing_documents_are_refused(spark):
    stored = {
        "same": {"m": {"x": 1}}, "clash": {"m": {"x": 1}, "l": [1]}, "deep": {"c": [{"id": 1, "h": {"a": 1}}]},
        "broken": {"m": {"x": 2}}, "gone": {"m": 5}, "null": {"m": {"x": 1}}, "scalar": {"m": {"x": 1}},
    }
    newer = {
        "same": {"m": {"y": 2}}, "clash": {"m": {"y": 2}, "l": 7}, "deep": {"c": [{"id": 2, "h": 3}, {"id": 1, "h": [1]}]},
        "null": {"m": None}, "new": {"m": [1]}, "scalar": 7,
    }
    docs = lambda d: [(k, json.dumps(v)) for k, v in d.items()]
    old = spark.createDataFrame([*docs(stored), ("bad", "{")], "channel_id string, doc string")
    new = spark.createDataFrame([*docs(newer), ("broken", '{"m":'), ("lost", "x"), ("bad", '{"m":1}')], old.schema)
    got = refresh_or_refuse(old, new, paths=("m", "l", "c.id:*.h"))
    kept = {r.channel_id: json.loads(r.doc) for r in got.docs.collect()}
    assert kept == {
        **{k: stored[k] for k in ("clash", "deep", "broken", "gone", "scalar", "null")},
        "same": {"m": {"x": 1, "y": 2}}, "new": {"m": [1]}, "bad": {"m": 1},
    }
    assert {r.channel_id: (r.doc, r.reason) for r in got.refused.collect()} == {
        "clash": (json.dumps(newer["clash"]), "ARRAY and SCALAR at l"),
        "deep": (json.dumps(newer["deep"]), "OBJECT and ARRAY at c.id:*.h"),
        "broken": ('{"m":', "not a JSON object"), "lost": ("x", "not a JSON object"),
        "scalar": ("7", "not a JSON object"),
    }
    plain = refresh_or_refuse(old, new, paths=())
    assert rows(plain.refused.select("channel_id")) == [("broken",), ("lost",), ("scalar",)]
