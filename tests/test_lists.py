"""JSON maps in pieces against the maps themselves, and the manifest of map files."""

from __future__ import annotations

import json
import os
import random

from pyspark.sql import functions as F

from chanlake.plans.anon_map import merge_map_files
from chanlake.session import settings
from chanlake.sources.channels import scan_channel_texts
from chanlake.sources.lists import scan_anon_maps, scan_seeds
from tests.conftest import rows

ODD = {'q",x': "h1", 'a\\': "h2", 'v': 'h",', "brace}": "x}", "{": "}", "space ": " t ", "": "", "é\n": "ж", "c": 'e"}'}


def test_maps_of_any_form_equal_the_maps(spark, tmp_path):
    rng = random.Random(3)
    maps = {
        "plain": {f"user {i}": f"{rng.getrandbits(256):064x}" for i in range(500)},
        "odd": ODD,
        "spaces": {"a": "b ", "c": " d  "},
        "one": {"a": "b"},
        "none": {},
        "nulls": {"a": None, "b": "x", "c": 5},
    }
    expected = []
    for name, given in maps.items():
        for form, options in {"": {}, "-wide": {"indent": 2}, "-tight": {"separators": (",", ":")}, "-utf": {"ensure_ascii": False}}.items():
            path = tmp_path / f"{name}{form}.json"
            path.write_text(json.dumps(given, **options) + ("\n" if form else ""))
            expected += [(path.name, k, None if v is None else str(v)) for k, v in given.items()]
    for name, text in {"cut": '{"a": "b", "c": "d', "empty": "", "text": "hello", "blank": " \n", "list": '["a", "b"]', "comma": '{"a": "b",}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = lambda: rows(scan_anon_maps(spark, str(tmp_path)).select(F.element_at(F.split("file_path", "/"), -1), "original", "hash"))
    assert found() == sorted(expected, key=repr)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}):
        split = scan_anon_maps(spark, str(tmp_path / "plain.json"))
        assert split.rdd.getNumPartitions() > 20  # one file, many tasks
        assert found() == sorted(expected, key=repr)


def test_seeds(spark, tmp_path):
    seeds = {str(i): i * 7 - 50 for i in range(300)} | {"a,b": 1, "": -2}
    for name, options in {"s": {}, "w": {"indent": 1}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(seeds, **options))
        assert rows(scan_seeds(spark, str(tmp_path / f"{name}.json"))) == sorted(seeds.items(), key=repr)


def test_a_late_map_file_with_an_old_time_is_merged(spark, tmp_path, key):
    maps, table = tmp_path / "maps", str(tmp_path / "table")
    maps.mkdir()
    (maps / "a.json").write_text('{"x": "1"}')
    merge_map_files(spark, str(maps), table, "1", key)
    (maps / "b.json").write_text('{"y": "2"}')
    os.utime(maps / "b.json", (1, 1))
    report = merge_map_files(spark, str(maps), table, "2", key)
    assert rows(spark.read.parquet(report.path).select("original", "hash")) == [("x", "1"), ("y", "2")]
    assert spark.read.parquet(f"{table}-files").count() == 2
    again = merge_map_files(spark, str(maps), table, "3", key)
    assert spark.read.parquet(again.path).count() == 2 and spark.read.parquet(f"{table}-files").count() == 2


def test_documents_of_several_lines_are_one_text(spark, tmp_path):
    doc = json.dumps({"chats": [{"id": 1}], "full_chat": {"id": 1}}, indent=2) + "\n"
    (tmp_path / "1.json").write_text(doc)
    assert rows(scan_channel_texts(spark, str(tmp_path)).select("value")) == [(doc,)]
