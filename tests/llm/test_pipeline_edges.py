"""Every stage of the pipeline on nulls, empty and long texts, ties, repeats, clashing names and no rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from chanlake.llm.catalog import table
from chanlake.session import materialised

SF = "/root/testdata/sf0.001"
CLASHING = ("size", "shard", "slot", "kept", "component_id", "score", "lang_pred", "rejected", "contaminated", "n_words", "taken", "steps", "step", "target")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows of ``documents`` with extra columns named as the stages' own ones."""
    real = table(spark, SF, "documents").filter("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").limit(80).collect()
    item = table(spark, SF, "benchmark").filter("text IS NOT NULL").orderBy("item_id").first().text
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in real]
    rows += [
        (10**6, None, None, None, None),
        (10**6 + 1, "", "en", "", 0),
        (10**6 + 2, " \n ", None, "web", 3),
        (10**6 + 3, real[0].text * 400, real[0].lang, None, None),
        (10**6 + 4, real[0].text + " " + item, real[0].lang, "web", None),
        (None, real[1].text, None, None, None),
        (real[2].doc_id, real[2].text, real[2].lang, real[2].source, real[2].n_chars),
    ]
    fields = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *("x",) * len(CLASHING)) for r in rows], fields)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows(spark, odd, name, stage):
    got = materialised(stage(spark, odd, SF), name)
    if name != "sharding":
        assert got.columns == odd.columns
        assert got.select(*CLASHING).distinct().collect() == [("x",) * len(CLASHING)]
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    given = [r.doc_id for r in odd.select("doc_id").collect()]
    assert set(ids) <= set(given)
    if name == "language_id":  # without letters nothing is known, and the rest stays
        assert not {10**6, 10**6 + 1, 10**6 + 2} & set(ids) and {10**6 + 3, 10**6 + 4} <= set(ids)
    if name == "near_duplicates":  # what has no words is linked with nothing; a copy goes, with an id or without
        assert {10**6, 10**6 + 1, 10**6 + 2} <= set(ids) and None not in ids
        repeated = given[2]
        assert given.count(repeated) == 2 and ids.count(repeated) <= 1
    if name == "decontamination":
        assert 10**6 + 4 not in ids and {10**6, 10**6 + 1, None} <= set(ids)
    if name == "sharding":
        assert sorted(ids, key=str) == sorted(given, key=str)
        places = got.groupBy("shard").agg({"slot": "max", "doc_id": "count"})
        assert got.select("shard", "slot").distinct().count() == len(given) and places.count() <= 16


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_without_rows(spark, odd, name, stage):
    got = stage(spark, odd.limit(0), SF)
    assert got.count() == 0 and set(odd.columns) <= set(got.columns)
