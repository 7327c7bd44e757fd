"""Rows without ids, with repeated ids, and equal rows."""

from __future__ import annotations

import glob
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chanlake.llm import langid, lm, mixing, quality
from chanlake.llm.decontaminate import contamination
from chanlake.llm.rows import numbered
from chanlake.llm.ship import ship

ENGLISH = "the quick brown fox jumps over lazy dogs while other people watch them".split()
FRENCH = "le renard brun saute par dessus des chiens paresseux pendant que nous regardons".split()


def prose(rng, words, n=20):
    return " ".join(rng.choice(words) for _ in range(n))


def test_languages_without_ids_are_all_learned(spark):
    rng = random.Random(1)
    rows = [(None, prose(rng, words), lang) for lang, words in (("en", ENGLISH), ("fr", FRENCH)) for _ in range(1500)]
    rows += [(7, "uno dos tres cuatro cinco seis siete ocho", "es")] * 1200  # one row, over and over
    model = langid.train(ship(spark).createDataFrame(rows, "doc_id long, text string, lang string").repartition(6), sample=300)
    assert set(model.labels) == {"en", "fr", "es"}


def test_k_is_kept_among_equal_rows(spark):
    rows = [(None, "the same text again and again")] * 90 + [(i, f"another text {i}") for i in range(10)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    ratio = quality.Ratio(np.zeros(64))
    for fraction in (0.5, 0.33, 0.02, 1.0):
        first, second = (quality.resample(docs.repartition(n), ratio, fraction).collect() for n in (3, 5))
        assert sum(r.sampled for r in first) == int(100 * fraction)
        assert Counter(first) == Counter(second)


def test_mixing_is_the_same_in_any_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, i]), rng.choice("ab"), prose(rng, ENGLISH, rng.randrange(30))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = [Counter(map(str, mixing.curriculum(docs.orderBy(F.rand(k)).repartition(k + 2)).collect())) for k in range(3)]
    assert found[0] == found[1] == found[2]


def test_contamination_goes_by_row(spark):
    item = " ".join(f"w{i}" for i in range(12))
    items = spark.createDataFrame([("i1", item)], "item_id string, text string")
    rows = [(None, f"before {item} after"), (None, "clean"), (5, item), (5, "w3 w4 clean too"), (5, item)]
    found = contamination(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in found), key=repr)
    assert got == sorted([(None, 14, 12, True), (None, 1, 0, False), (5, 12, 12, True), (5, 12, 12, True), (5, 4, 0, False)], key=repr)


def test_numbers_are_in_the_order_of_ids(spark):
    rows = [(None, "b"), (3, "x"), (None, "a"), (1, "y"), (3, "x"), (2, None)]
    got = sorted(numbered(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "n").collect(), key=lambda r: r.n)
    assert [r.n for r in got] == list(range(1, 7)) and [r.doc_id for r in got] == [1, 2, 3, 3, None, None]


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    ship(spark)
    rng = random.Random(5)
    one, other, third = (prose(rng, [f"v{i}" for i in range(500)], 60) for _ in range(3))
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(3, one), (7, one), (7, other), (None, other), (None, third), (None, third), (9, f"{item} x"), (9, "only this")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    want = [(3, one), (7, other), (9, "only this"), (9, f"{item} x"), (None, third)]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)
    spark.createDataFrame([("i", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.decontaminate_benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, clean), key=repr) == sorted([r for r in rows if item not in r[1]], key=repr)


def test_a_lost_file_of_the_model_is_an_error(spark):
    ship(spark)
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, prose(rng, ENGLISH)) for i in range(60)], "doc_id long, text string")
    model = lm.train(docs)
    assert lm.score(docs, model).count() == 60
    files = sorted(glob.glob(f"{model.folder}/{model.order}/*/*-counts.npy"))
    large = max(files, key=os.path.getsize)
    os.rename(large, f"{large}.lost")
    with pytest.raises(Exception, match="has lost"):
        lm.score(docs, model).collect()


def test_counts_beyond_32_bits():
    level = lm.Level(1, {})
    words, counts = np.array([5, 9], np.uint64), np.array([1 << 33, 2])
    table = pa.Table.from_batches(list(lm._record_batches(lm._blocks([words], counts, counts, level))))
    columns, adjusted, raw = lm._read_blocks(table, 1)
    assert columns[0].tolist() == [5, 9] and adjusted.tolist() == raw.tolist() == [1 << 33, 2]
