"""What the near-duplicate stage leaves behind."""

from __future__ import annotations

from pathlib import Path

import corpus_pipeline
from chanlake.llm.ship import ship
from chanlake.session import shared_dir


def test_near_stage_keeps_no_copy_of_the_texts(spark):
    ship(spark)
    words = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame(
        [(1, words, "x"), (1, words, "x"), (2, words, "y"), (None, words, None), (3, None, "z"), (3, None, "z"), (3, "", "z"), (None, None, "z")],
        "doc_id long, text string, lang string",
    )
    before = {p.name for p in Path(shared_dir(spark)).iterdir()}
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    left = {p.name for p in Path(shared_dir(spark)).iterdir()} - before
    assert not any(name.startswith("ranked") for name in left)  # all texts, till the session's end, before
    expected = [(1, words, "x"), (3, "", "z"), (3, None, "z"), (3, None, "z"), (None, None, "z")]
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(expected, key=repr)
