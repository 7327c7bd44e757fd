"""Groups of equal texts above a mean shard leave the other shards even."""

from __future__ import annotations

import random

import pytest

from chanlake.llm import sharding


@pytest.mark.parametrize("part", [1 / 12, 1 / 8, 1 / 3, 0.95])
def test_large_group_leaves_no_shard_empty(part):
    rest = [1000 + i % 7 for i in range(3000)]
    large = int(part / (1 - part) * sum(rest))
    bins = sharding.pack_evenly([large, *rest], 16)
    totals = [0] * 16
    for size, b in zip([large, *rest], bins, strict=True):
        totals[b] += size
    own = totals.pop(bins[0])
    assert own == large and max(totals) <= 1.02 * min(totals)
    assert len(set(sharding.pack_evenly([5] * 5, 4))) == 4
    assert sharding.pack_evenly([], 16) == []


def test_shard_with_a_third_in_one_group(spark):
    rng = random.Random(9)
    texts = ["x" * rng.randrange(200, 900) for _ in range(2000)]
    texts += ["large " * 50] * (sum(map(len, texts)) // 600)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard(docs).collect()
    totals = [sum(r["size"] for r in rows if r.shard == s) for s in range(16)]
    large = {r.shard for r in rows if r.text.startswith("large")}
    assert len(large) == 1 and totals.pop(large.pop()) > 0.3 * sum(len(t) + 1 for t in texts)
    assert max(totals) <= 1.1 * min(totals)
