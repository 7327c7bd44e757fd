"""Every stage of the pipeline on its own input, against brute force."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from chanlake.llm.catalog import table
from chanlake.session import materialised
from tests.llm.test_operators import brute_near

SF = "/root/testdata/sf0.001"


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_stages(spark):
    docs, kept = table(spark, SF, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept.append(docs.collect())
        docs = materialised(stage(spark, docs, SF), name)
        assert docs.columns[: len(columns)] == columns
    raw, known, single, clean, mix = kept
    final = docs.collect()
    assert len(known) > 0.98 * len(raw)
    known.sort(key=lambda r: r.doc_id)
    ids = [r.doc_id for r in known]
    assert sorted(r.doc_id for r in single) == [ids[i] for i, _, _, own in brute_near([r.text for r in known], 80) if own]
    grams = set()
    for r in table(spark, SF, "benchmark").collect():
        w = words(r.text)
        grams |= {tuple(w[i : i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    sizes = {len(g) for g in grams}
    hit = {r.doc_id for r in single for w in [words(r.text)] for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in grams}
    assert {r.doc_id for r in clean} == {r.doc_id for r in single} - hit
    assert max(Counter(r.doc_id for r in mix).values()) <= 2 and {r.doc_id for r in mix} <= {r.doc_id for r in clean}
    count = lambda rows: sum(len((r.text or "").encode().split()) for r in rows)
    assert abs(count(mix) / count(clean) - 1.5) < 0.3
    assert Counter(r.doc_id for r in final) == Counter(r.doc_id for r in mix)
    for s in range(16):
        own = sorted(r.slot for r in final if r.shard == s)
        assert own == list(range(len(own)))
