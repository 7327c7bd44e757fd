"""Removal of repeated substrings against brute force, with nulls, long and odd texts, ties and repeats."""

from __future__ import annotations

import random

import numpy as np
import pytest

from chanlake.llm import suffixes
from chanlake.llm.catalog import table
from chanlake.llm.suffixes import remove_repeats

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(kept bytes, spans) for each (id, text)."""
    least = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            window = data[i : i + 50]
            least[window] = min(least.get(window, float("inf")), float("inf") if key is None else key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if least[data[i : i + 50]] < (float("inf") if key is None else key):
                gone[i : i + 50] = b"\1" * 50
        spans, at = [], 0
        while (at := gone.find(1, at)) >= 0:
            end = (gone.find(0, at) + len(gone) + 1) % (len(gone) + 1) if gone.find(0, at) >= 0 else len(gone)
            spans.append((at, end))
            at = end
        out.append((key, text, bytes(b for b, g in zip(data, gone, strict=True) if not g), spans))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.text, bytes(r.kept), [tuple(s) for s in r.spans]) for r in df.collect()), key=repr)


def odd_rows():
    rng = random.Random(5)

    def words(n):
        return " ".join(rng.choice(["ab", "é", "the", "x" * 9, "日本", "of", f"{rng.randrange(999)}"]) for _ in range(n))

    passages = [words(40) for _ in range(6)]
    rows = [(i, words(rng.randrange(60)) + rng.choice(passages)[: rng.randrange(120)] + words(8)) for i in range(80)]
    rows += [(100, "a" * 400), (101, "a" * 130 + "b" + "a" * 49), (102, "ab" * 90), (103, "ba" * 25), (104, "")]
    rows += [(105, None), (None, "a" * 60), (None, passages[0]), (None, passages[0]), (None, None)]
    rows += [(106, passages[1] * 3), (106, passages[1] * 3), (106, passages[2] + passages[1])]
    rows += [(200 + i, passages[3]) for i in range(30)] + [(3, passages[4]), (-7, passages[5] + "é" * 40)]
    return rows


@pytest.mark.parametrize("rounds", [1, 3])
def test_odd_texts(spark, rounds):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(remove_repeats(frame, rounds)) == brute(rows)


def test_blocks_do_not_matter(spark, monkeypatch):
    """Texts longer than a block are cut into pieces that overlap."""
    rows = odd_rows()
    data = [(t or "").encode() for _, t in rows]
    offsets = np.cumsum([0, *map(len, data)])
    text = np.frombuffer(b"".join(data), np.uint8)

    def windows():
        found = set()
        for low, high, doc, origin in suffixes._blocks(offsets):
            bounds = np.clip(offsets[doc[0] : doc[-1] + 2], low, high) - low
            runs = suffixes.runs_of(text[low:high], bounds, doc, origin, np.arange(len(rows)), np.arange(len(rows)))
            for d, s, n in zip(runs.doc, runs.start, runs.lengths, strict=True):
                found |= {(int(d), int(s) + i) for i in range(int(n) - 49)}
        return found

    whole = windows()
    monkeypatch.setattr(suffixes, "BLOCK", 64)
    assert windows() == whole == {(d, i) for d, t in enumerate(data) for i in range(len(t) - 49)}


def test_packing():
    rng = np.random.default_rng(1)
    doc = np.repeat([0, 3, 1], [4, 1, 5])
    start = np.concatenate([np.sort(rng.integers(0, 10**6, n)) for n in (4, 1, 5)])
    lengths = rng.integers(50, 85, 10)
    runs = suffixes.Runs(
        rng.integers(0, 256, lengths.sum()).astype(np.uint8), lengths, rng.integers(0, 35, 10), start, doc,
        np.array([5, -9, 2, suffixes.LAST_ID]), np.array([1, -2, 3, -4]),
    )
    back = suffixes.Runs.unpacked(runs.packed())
    assert (back.ids[back.doc] == runs.ids[doc]).all() and (back.keys[back.doc] == runs.keys[doc]).all()
    for name in ("content", "lengths", "gram", "start"):
        assert (getattr(back, name) == getattr(runs, name)).all(), name


def test_clashing_names_and_no_rows(spark):
    frame = spark.createDataFrame([(2, "z" * 70, 1, "k"), (1, "z" * 60, 2, "s")], "doc_id long, text string, _id int, kept string")
    got = {r.doc_id: r for r in remove_repeats(frame).collect()}
    assert got[2]._id == 1 and bytes(got[2].kept) == b"" and got[1].spans == []
    assert remove_repeats(frame.limit(0)).count() == 0


def test_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    assert result(remove_repeats(docs)) == brute([tuple(r) for r in docs.collect()])
