"""The stored word index against a plain search, over updates and updates that died."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from chanlake.operators.word_index import PARTS, POSTINGS, WordIndex
from tests.conftest import rows

SCHEMA = "id string, text string"


def plain(texts: dict, keywords: list) -> list:
    found = []
    for keyword in keywords:
        asked = [w for w in re.split(r"\W+", (keyword or "").lower()) if w]
        for i, text in texts.items():
            own = [w for w in re.split(r"\W+", (text or "").lower()) if w]
            if asked and any(own[k : k + len(asked)] == asked for k in range(len(own))):
                found.append((keyword, i))
    return sorted(found, key=repr)


def asked(spark, keywords):
    return spark.createDataFrame([(k,) for k in keywords], "keyword string")


@pytest.fixture
def index(spark, tmp_path):
    return WordIndex(spark, str(tmp_path / "index"))


def test_equals_a_plain_search_over_updates(spark, index):
    rng = random.Random(5)
    text = lambda: " ".join(rng.choices(["The", "the", "red", "Fox,", "ran", "a_b", "ж"], k=rng.randint(0, 12)))
    texts = {f"c{i:02d}": text() for i in range(40)} | {"none": None, "empty": "", "marks": "!?"}
    keywords = ["the", "the the", "the the the", "red fox", "THE RED", "fox ran the", "a_b", "ж red", "gone", "red gone", "...", "", None]
    assert rows(index.search(asked(spark, keywords))) == []  # nothing taken in yet
    assert index.update(spark.createDataFrame(list(texts.items()), SCHEMA), F.col("text")) == len(texts)
    assert rows(index.search(asked(spark, keywords * 2)), "keyword", "id") == plain(texts, keywords)
    again = {i: text() if n % 3 == 0 else t for n, (i, t) in enumerate(texts.items())} | {"new": "red fox"}
    changed = sum((t or "") != (texts.get(i) or "") for i, t in again.items() if i != "new") + 1
    assert index.update(spark.createDataFrame(list(again.items()), SCHEMA), F.col("text")) == changed
    assert rows(index.search(asked(spark, keywords)), "keyword", "id") == plain(again, keywords)
    assert index.update(spark.createDataFrame(list(again.items()), SCHEMA), F.col("text")) == 0


def test_repeated_and_absent_ids(spark, index):
    channels = [("a", "red"), ("a", "blue"), ("a", None), (None, "red")]
    index.update(spark.createDataFrame(channels, SCHEMA), F.col("text"))
    assert rows(index.search(asked(spark, ["red", "blue"]))) == [("red", "a")]  # the largest text counts


def test_an_update_that_died_is_not_found(spark, index):
    index.update(spark.createDataFrame([("a", "red fox")], SCHEMA), F.col("text"))
    part = spark.range(1).select(F.pmod(F.xxhash64(F.lit("blue")), F.lit(PARTS)).cast("int")).first()[0]
    stale = spark.createDataFrame([("blue", "a", "dead", [0], part)], POSTINGS)
    stale.write.mode("append").partitionBy("part").parquet(f"{index.root}/postings")
    assert rows(index.search(asked(spark, ["blue", "red"]))) == [("red", "a")]


def test_only_the_folders_of_asked_words_are_read(spark, index):
    texts = [(f"c{i}", f"word{i} common") for i in range(200)]
    index.update(spark.createDataFrame(texts, SCHEMA), F.col("text"))
    found = index.search(asked(spark, ["word7"]))
    assert rows(found) == [("word7", "c7")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
