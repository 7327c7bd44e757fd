"""The near-duplicate stage at a similarity of 0.8."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from chanlake.llm import neardup
from chanlake.llm.ship import ship


def similarity(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_near_stage_at_four_fifths(spark):
    ship(spark)
    rng, rows = random.Random(8), []
    for k in range(12):  # 200 words and a copy with four, or six, spread words changed
        words = [f"w{rng.randrange(10**5)}" for _ in range(200)]
        copy = list(words)
        for place in range(20, 200, 45 if k < 8 else 30):
            copy[place] = f"n{rng.randrange(10**6)}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    alike = [similarity(rows[i][1], rows[i + 1][1]) for i in range(0, len(rows), 2)]
    assert all(0.8 <= s < 0.85 for s in alike[:8]) and all(s < 0.8 for s in alike[8:])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(range(0, 24)) - set(range(1, 16, 2))
    assert all(r.kept for r in neardup.near_duplicates(docs).collect())  # op6 stays at 0.85
    with pytest.raises(ValueError):
        neardup.near_duplicates(docs, threshold=(79, 100), distance=29)
