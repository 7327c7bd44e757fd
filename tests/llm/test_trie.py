"""The trie against brute force, with ties, repeats, nulls, hot openings and a sketch that is too small."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from chanlake.llm import trie
from chanlake.llm.trie import NO_ENDS, prefix_trie, turns_of, with_borrowed_openings

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def below(path):
        found = [path]
        for p in found:
            found += children.get(p, [])
        return found

    out = []
    for path, members in nodes.items():
        sub = below(path)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(path)))
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].split()) for p in sub if p)
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children.get(path, [])),
            sum(p not in children for p in sub), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def some_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), 220):
        texts = [rng.choice(["hi", "hi there", "", None, "so it is", "é à"]) for _ in range(rng.randrange(1, 9))]
        turns = rng.sample([None, *range(20)], len(texts))
        rows += [(c, t, rng.choice(["user", "assistant", None]), x) for t, x in zip(turns, texts, strict=True)]
    rows += [(1000 + i, 0, "system", "the same first words") for i in range(60)]
    rows += [(1000 + i, 1, "user", "and the same next") for i in range(40)]
    return rows + [(2**63 - 1, 1, "user", "last id"), (None, 1, "user", "no id"), (7000, 2, None, None)]


@pytest.mark.parametrize("widths", [None, (2, 2)])
def test_against_brute_force(spark, monkeypatch, widths):
    if widths:  # nearly all prefixes look shared; the result is the same
        monkeypatch.setattr(trie, "WIDTHS", widths)
    rows = some_rows(1)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie(with_borrowed_openings(turns_of(frame.repartition(6))))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_sketch_proves_singletons(spark):
    rows = [(c, t, "user", f"{c} {t}" if t else "shared") for c in range(1, 400) for t in range(6) if c % 20]
    turns = with_borrowed_openings(turns_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    prefixes = trie._checkpointed(spark, trie._prefixes(turns))
    sketch = trie.sketch_of(prefixes, 1 << 14)
    assert set(sketch.tolist()) <= {0, 1, 2}
    counted = {}
    for r in prefixes.filter("depth > 0").collect():
        counted[r.hi, r.lo] = counted.get((r.hi, r.lo), 0) + 1
    hi, lo = (np.array([k[i] for k in counted], np.int64) for i in (0, 1))
    estimate = sketch[trie._counters(hi, lo, 1 << 14)].min(0)
    true = np.minimum(list(counted.values()), 2)
    assert (estimate >= true).all() and (estimate == true).mean() > 0.99


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, depth int, hi string"
    empty = spark.createDataFrame([], schema)
    assert prefix_trie(with_borrowed_openings(turns_of(empty))).count() == 0
    # alone, and left without a turn: all of its own are replaced by none
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    frame = spark.createDataFrame([(lone, 1, "user", "x", 9, "y"), (lone, 1, "user", "x", 9, "y")], schema)
    ends = hashlib.sha256(str(lone).encode()).hexdigest()
    assert list(map(tuple, prefix_trie(with_borrowed_openings(turns_of(frame))).collect())) == [(lone, 0, None, 1, 0, 1, 0, ends)]
    # a conversation of many turns is a chain
    long = spark.createDataFrame([(20, t, "user", f"turn {t}") for t in range(3000)], "conv_id long, turn long, role string, text string")
    got = prefix_trie(with_borrowed_openings(turns_of(long))).collect()
    assert len(got) == 3001 and sum(r.ends_sha256 != NO_ENDS for r in got) == 1 and {r.saved_tokens for r in got} == {0}
