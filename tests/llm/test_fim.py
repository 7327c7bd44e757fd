"""Cut texts against brute force and an exact round trip; the boundary set against a plain list."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chanlake.llm import boundaries
from chanlake.llm.boundaries import BoundarySet
from chanlake.llm.fim import Recipe, fill_in_middle, restore


def brute(row_id, text, recipe):
    text = text or ""
    pattern = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+" if recipe.units == "words" else r"(?s:.)"
    units = re.findall(pattern, text)
    digest = hashlib.sha256(f"{recipe.seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= recipe.rate:
        return row_id, len(units), "plain", None, None, text
    if h[3] % 100 < recipe.suffix_first:
        return row_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return row_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_texts():
    rng = random.Random(4)
    marks = [" ", "\n", "\t\x0b", " ", "é", "日本", "x", "word", "😀", "<", "<P", "P>", "S>", "M"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(12))) for _ in range(250)]
    texts += [None, "", " ", "a", " a", "a ", "no <S> here", "<P>", "w " * 40_000, "x" * 70_000, "é" * 70_000]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "without id at all"), (7, "twice the same"), (7, "twice the same")]


@pytest.mark.parametrize("recipe", [Recipe(), Recipe(100, 50, 1, "characters"), Recipe(0), Recipe(100, 0)])
def test_against_brute_force(spark, recipe):
    rows = odd_texts()
    made = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), recipe)
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute(i, t, recipe) for i, t in rows), key=repr)
    back = made.filter(restore(F.col("output"), F.col("form")) != F.coalesce("text", F.lit("")))
    assert back.count() == 0


def test_clashing_names_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a b", "x", 5, 6)], "doc_id long, text string, form string, _draws int, _rest int")
    row = fill_in_middle(frame).first()
    assert (row._draws, row._rest, row.n) == (5, 6, 2)
    assert fill_in_middle(frame.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {(r.n, r.form, r.output) for r in fill_in_middle(blank).collect()} == {(0, "plain", "")}
    with pytest.raises(ValueError):
        Recipe(units="lines")


def test_boundary_set():
    rng = np.random.default_rng(3)
    span = boundaries.SPAN
    sparse = rng.choice(span, 300, replace=False)
    dense = span * 2 + rng.choice(span, 30_000, replace=False)
    runs = span * 5 + np.concatenate([np.arange(0, 5000), np.arange(9000, 60_000)])
    places = np.sort(np.concatenate([sparse, dense, runs, [span * 9 - 1, span * 9]]))
    found = BoundarySet(places)
    kinds = [type(c) for c in found.containers]
    assert kinds[:3] == [boundaries.Values, boundaries.Bitmap, boundaries.Stretches] and len(found) == len(places)
    ranks = rng.permutation(len(places))
    assert (found.select(ranks) == places[ranks]).all()
    assert len(BoundarySet(np.zeros(0, np.int64)).select(np.zeros(0, np.int64))) == 0
    with pytest.raises(IndexError):
        found.select(np.array([len(places)]))
