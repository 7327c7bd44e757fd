"""Vectorised words against Python's own splitting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from chanlake.llm import words
from chanlake.llm.words import pieces, row_sums, word_hashes

TEXT = st.text(alphabet=st.sampled_from("abAB \t\n\r\x0b\x0c\x1c é😀"), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_words_equal_split(texts):
    hashes, counts = word_hashes(pa.array(texts, pa.string()))
    want = [(t or "").encode().lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for row in want for w in row]
    assert len({*zip(flat, hashes.tolist(), strict=True)}) == len(set(flat)) == len(set(hashes.tolist()))


def test_long_words_and_blocks(monkeypatch):
    text = "x" * 300 + " " + " ".join(str(i) for i in range(200)) + " " + "X" * 300
    whole = word_hashes(pa.array([text, None, ""]))
    monkeypatch.setattr(words, "_BLOCK", 64)
    parts = word_hashes(pa.array([text, None, ""]))
    assert whole[1].tolist() == parts[1].tolist() == [202, 0, 0]
    assert (whole[0][1:-1] == parts[0][1:-1]).all()
    assert parts[0][0] == parts[0][-1] and whole[0][0] == whole[0][-1]


def test_many_words_differ():
    flat = [f"w{i}" for i in range(200_000)]
    hashes, _ = word_hashes(pa.array([" ".join(flat)]))
    assert len(np.unique(hashes)) == len(flat)


def test_pieces_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["ab" * i for i in range(50)] + [None]})
    parts = list(pieces(batch, "text", 100))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    assert row_sums(np.array([1.0, 2.0]), np.array([0, 2, 0])).tolist() == [0, 3, 0]
