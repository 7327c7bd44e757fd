"""The other operators against brute force, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chanlake.llm import decontaminate, langid, mixing, neardup, quality, secrets, sharding, topk
from chanlake.llm.components import connected
from chanlake.llm.ship import ship


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: min(y for y in parent if root(y) == root(x)) for x in parent}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts():
    rng = random.Random(2)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    texts = ["", None, "  ", "one two", "ONE two", "one two three four five", " ".join(base).upper()]
    for _ in range(60):  # copies with changes, some beyond the threshold
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    return texts + texts[:20]


def brute_near(texts, over=85):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    found = list(range(len(texts)))
    for _ in texts:
        before = list(found)
        for i, x in enumerate(sets):
            for j in range(i):
                y = sets[j]
                if x and y and 100 * len(x & y) >= over * len(x | y):
                    found[i] = found[j] = min(found[i], found[j])
        if before == found:
            break
    return [(i, len(s), found[i], found[i] == i) for i, s in enumerate(sets)]


@pytest.mark.parametrize("block", [128, 8])
def test_near_duplicates(spark, monkeypatch, block):
    ship(spark)
    monkeypatch.setattr(neardup, "BLOCK", block)  # large groups meet in pairs of blocks
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect())) == brute_near(texts)
    extra = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f")], "doc_id long, text string")
    rows = {r.doc_id: r for r in neardup.near_duplicates(extra).collect()}
    assert rows[None].kept and rows[None].component_id is None and rows[7].kept
    assert neardup.near_duplicates(extra.limit(0)).count() == 0
    with pytest.raises(ValueError):
        neardup.near_duplicates(extra, threshold=(80, 100))


def test_keys_find_all_pairs_within_the_distance():
    keys, rng = neardup._key_columns(), random.Random(3)
    for _ in range(2000):
        wrong = set(rng.sample(range(neardup.SYMBOLS), neardup.DISTANCE))
        assert any(not wrong & set(k) for k in keys)


@pytest.mark.parametrize("rounds", [topk.ROUNDS, (1.0,)])
def test_top_of_block(rounds):
    rng = np.random.default_rng(4)
    ids = rng.permutation(400).astype(np.int64)
    values = rng.integers(-9, 9, (400, 3))
    values[::3] *= 20  # a few clear winners: early stops
    asked = rng.integers(-5, 5, (30, 3))
    query, got, score = topk.top_of_block(ids, values, ids[:30], asked, 5, rounds)
    for q, v in zip(ids[:30], asked, strict=True):
        want = sorted((-int(v @ x), i) for i, x in zip(ids.tolist(), values, strict=True) if i != q)[:5]
        mine = query == q
        assert sorted(zip((-score[mine]).tolist(), got[mine].tolist(), strict=True)) == want


def test_top_k(spark):
    ship(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 4), -0.5]) for i in range(30)] + [(30, None), (31, [nan, 1.0]), (32, [inf, 1.0]), (33, [None, 1.0]), (None, [1.0, 1.0]), (34, [1.0]), (0, [0.0, -0.5]), (35, [1e9, 1e9])]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert vectors.count() == 32
    v = {r.id: (list(r.v) + [0, 0])[:2] for r in vectors.collect()}
    got = topk.top_k(vectors, vectors.filter("id % 10 = 0"), 3, block_rows=7, query_rows=2).collect()
    for q in (0, 10, 20):
        want = sorted((-sum(a * b for a, b in zip(v[q], x, strict=True)), i) for i, x in v.items() if i != q)[:3]
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want
    few = topk.top_k(vectors.filter("id < 2"), vectors.filter("id = 0"), 5)
    assert [r.vec_id for r in few.collect()] == [1]
    assert topk.top_k(vectors, vectors.limit(0)).count() == 0


def test_curriculum(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "é", None]), "w " * rng.randrange(40), 7) for i in range(400)] + [(400, "z", None, 7), (1, "a", "w", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    mixed = mixing.curriculum(docs).collect()
    assert len(mixed) == len(rows)
    names = ["a", "b", "z", "é", None]
    size = {n: sum(len((t or "").split()) for _, s, t, _ in rows if s == n) for n in names}
    weight, target = dict(zip(names, (5, 2, 1, 5, 2), strict=True)), {}
    left, free = 1.5 * sum(size.values()), set(names)
    while True:  # shares again and again until none is above twice its size
        unit = left / sum(weight[n] for n in free)
        over = {n for n in free if unit * weight[n] > 2 * size[n]}
        if not over:
            break
        for n in over:
            target[n] = 2.0 * size[n]
            left, free = left - target[n], free - {n}
    target |= {n: unit * weight[n] for n in free}
    for n in names:
        own = [r for r in mixed if r.source == n]
        assert all(r.source_size == size[n] and r.target == pytest.approx(target[n]) for r in own)
        assert abs(sum(r.taken for r in own) - target[n]) <= 20
        assert all(r.taken == r.size * len(r.steps) and len(r.steps) <= 2 for r in own)
    order = [r.step for r in mixing.training_order(mixing.curriculum(docs)).collect()]
    assert order == sorted(order) and len(order) == sum(len(r.steps) for r in mixed)
    assert mixing.curriculum(docs.limit(0)).count() == 0
    # a rising source gives its first half later than a falling one
    t = spark.range(1).select(mixing.time_of(F.lit(0.5), F.lit(0.5), F.lit(1.5)), mixing.time_of(F.lit(0.5), F.lit(1.5), F.lit(0.5))).first()
    assert t[0] > 0.5 > t[1]
    with pytest.raises(ValueError):
        mixing.Recipe(weights=(0, 1, 2))


def test_best_fit_decreasing():
    rng = random.Random(6)
    sizes = [rng.randrange(1, 60) for _ in range(900)] + [500]
    bins, room = sharding.best_fit_decreasing(sizes, 100), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):  # the same by linear search
        fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
        b = min(fits)[1] if fits else len(room)
        if not fits:
            room.append(max(100, sizes[i]))
        room[b] -= sizes[i]
        assert bins[i] == b
    assert len(room) <= sum(sizes) / 100 * 11 / 9 + 4


def test_shard(spark):
    rng = random.Random(7)
    texts = ["x" * rng.randrange(900) for _ in range(600)] + ["é" * 300] * 40 + [None, ""]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, slot int")
    rows = sharding.shard(docs, 4).collect()
    assert len(rows) == len(texts)
    by = {s: [r for r in rows if r.shard == s] for s in range(4)}
    totals = [sum(r["size"] for r in own) for own in by.values()]
    assert sum(totals) == sum(len((t or "").encode()) + 1 for t in texts) and max(totals) <= 1.05 * min(totals)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())
    assert len({r.shard for r in rows if (r.text or "").startswith("é")}) == 1
    assert sharding.shard(docs.limit(0), 4).count() == 0


def test_contamination(spark):
    item = "The Quick brown fox jumps over one lazy dog again and again"
    items = spark.createDataFrame([(1, item), (2, "Short Item"), (3, None), (4, "..."), (None, "free text"), (10, "Short item")], "item_id long, text string")
    fox = item.lower().replace(" ", "--")
    rows = [(1, f"so {fox} end"), (2, "a short item, SHORT ITEM short"), (3, "quick brown fox"), (4, None), (5, ""), (6, f"{fox} {fox}"), (7, "free text"), (None, fox), (2, "a short item, SHORT ITEM short")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_hit string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, items).collect() if r.doc_id)
    assert got == [(1, 14, 12, 1, True), (2, 6, 4, 2, True), (2, 6, 4, 2, True), (3, 3, 0, 0, False), (4, 0, 0, 0, False), (5, 0, 0, 0, False), (6, 24, 24, 1, True), (7, 2, 0, 0, False)]
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count()
    index = decontaminate.build_index(docs.filter("doc_id = 3"), items.filter("item_id = 1"))
    windows, _ = decontaminate.windows_of(items.filter("item_id = 1"), 3)
    assert decontaminate.proximity_matches(index, windows, 1).count() >= 1


def test_languages_held_out(spark):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.filter("doc_id % 5 <> 0").select("doc_id", "text", "lang"))
    found = langid.identify(docs.filter("doc_id % 5 = 0").withColumn("score", F.lit("x")), model)
    assert found.filter("lang = lang_pred").count() / found.count() > 0.97
    assert found.filter("NOT rejected").count() / found.count() > 0.99
    odd = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "12 34!", "en"), (4, "日本語の文章です", "en"), (5, "the and of " * 90000, None)], "doc_id long, text string, lang string")
    rows = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(rows[i].rejected for i in (1, 2, 3, 4))
    assert rows[5].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows.values())
    none = langid.train(odd.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, none).collect()} == {"und"}


def test_resampling(spark):
    ship(spark)
    rows = [(i, "good words here", None) for i in range(50)] + [(50 + i, "bad $$ junk", 1) for i in range(50)] + [(100, None, 1), (101, "", 1), (None, "good", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(i, 0) for i in range(50, 70)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    ratio = quality.fit(docs, labels, buckets=64)  # few words: few buckets, or smoothing rules
    got = quality.resample(docs, ratio, 0.5).collect()
    assert len(got) == len(rows) and sum(r.sampled for r in got) == len(rows) // 2
    keys = sorted((r.key for r in got), reverse=True)
    assert min(r.key for r in got if r.sampled) == keys[len(rows) // 2 - 1]
    assert {r.doc_id: r.n_features for r in got}[100] == 0 and {r.doc_id: r.n_features for r in got}[0] == 5
    weights = {r.doc_id: r.log_weight for r in got}
    assert weights[0] > 0 > weights[50]
    assert set(quality.fit(docs, labels.limit(0)).log_ratio) == {0.0}
    assert quality.resample(docs.limit(0), ratio).count() == 0


def test_secrets(spark):
    hexes = [f"{random.Random(i).getrandbits(160):040x}" for i in range(60)]
    rows = [(i, f'some words token = "{h}" and more {1234567890123456 + i} end') for i, h in enumerate(hexes)]
    rows += [(100, None), (101, ""), (102, "plain text"), (None, f'token = "{hexes[0]}"'), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.scan(docs, learn_from=F.col("doc_id") % 2 == 0).collect()
    assert len(found) == 120
    assert all(r.is_secret == (len(r.value) == 40) for r in found)  # odd ids are held out
    assert secrets.scan(docs.filter("doc_id > 100")).count() == 0
    kept = secrets.scan(docs, labels=spark.createDataFrame([], "doc_id long, occurrence int, is_secret int"))
    assert all(r.is_secret for r in kept.collect())
