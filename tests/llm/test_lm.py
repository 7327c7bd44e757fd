"""The language model against a model counted and smoothed in plain Python."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from chanlake.llm import lm
from chanlake.llm.ship import ship

TEXTS = [
    "a b c a b d", "the cat the dog the cat sat", "x", "", None, "A B c\ta b e", "the the the the a b c a b d",
    "a b", "c d e f g h i j a b", "the cat sat on a mat", "x y z x y", "the dog sat on a cat",
]
EXTRA = "unseen words the cat"


def tokens(text):
    return (text or "").lower().split() + ["</s>"]


def brute(texts, order):
    grams = {m: Counter() for m in range(1, order + 1)}
    for text in texts:
        t = ["<s>"] * (order - 1) + tokens(text)
        for i in range(order - 1, len(t)):
            grams[order][tuple(t[i - order + 1 : i + 1])] += 1
    raw = Counter(w for t in texts for w in tokens(t))
    for m in range(order - 1, 0, -1):
        grams[m] = Counter(g[1:] for g in grams[m + 1])
    discounts, totals, kinds = {}, {}, {}
    for m, counts in grams.items():
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        discounts[m] = lm._discounts(__import__("numpy").array(n))
        totals[m], kinds[m] = Counter(), defaultdict(lambda: [0, 0, 0])
        for g, c in counts.items():
            totals[m][g[:-1]] += c
            kinds[m][g[:-1]][min(c, 3) - 1] += 1

    def p(context, word):
        if not context and not totals[1]:
            return 1 / (len(raw) + 1)
        m = len(context) + 1
        lower = p(context[1:], word) if context else 1 / (len(raw) + 1)
        if not totals[m][context]:
            return lower
        c = grams[m][(*context, word)]
        d = discounts[m]
        gamma = sum(k * x for k, x in zip(kinds[m][context], d[1:], strict=True))
        return (c - d[min(c, 3)] + gamma * lower) / totals[m][context]

    def score(text):
        t = ["<s>"] * (order - 1) + tokens(text)
        return sum(math.log10(p(tuple(t[i - order + 1 : i]), t[i])) for i in range(order - 1, len(t)))

    n, v = sum(raw.values()), len(raw)
    base = lambda text: sum(math.log10((raw[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(text))
    return score, base, raw, p


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("hot", [False, True])
def test_equals_brute_force(spark, monkeypatch, order, hot):
    ship(spark)
    if hot:  # many buckets, so that frequent contexts are dealt to several
        monkeypatch.setattr(lm, "BUCKET_TOKENS", 2)
    rows = [(i, t, "k") for i, t in enumerate(TEXTS)] + [(99, EXTRA, "k"), (None, EXTRA, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    model = lm.train(docs.filter("doc_id < 99"), order, bucket_tokens=lm.BUCKET_TOKENS)
    if hot:
        assert any(level.hot for level in model.levels.values())
    score, base, raw, p = brute(TEXTS, order)
    assert (model.tokens, model.vocabulary) == (sum(raw.values()), len(raw))
    got = {r.doc_id: r for r in lm.score(docs, model).collect()}
    for i, text, _ in rows:
        r = got[i]
        assert r.n_tokens == len(tokens(text)) and r.n_known == sum(raw[w] > 0 for w in tokens(text))
        assert r.base_score == pytest.approx(base(text), abs=1e-9)
        assert r.score == pytest.approx(score(text), abs=1e-9)
    # the probabilities of all words and one unseen word add up to 1
    for context in (("<s>",) * (order - 1), ("the",) * (order - 1), ("unseen",) * (order - 1)):
        assert sum(p(context, w) for w in [*raw, "unseen"]) == pytest.approx(1)


def test_without_texts(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = lm.train(docs.limit(0))
    row = lm.score(docs, model).first()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (3, 0, 0.0, 0.0)
    assert lm.score(docs.limit(0), model).count() == 0
