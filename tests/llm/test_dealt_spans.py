"""Spans of repeated substrings in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute

from chanlake.llm import suffixes


def test_a_bucket_gives_a_row_for_each_part_not_for_each_document():
    rng = np.random.default_rng(3)
    rows = [(d, np.sort(rng.integers(0, 999, 1 + d % 4)), np.sort(rng.integers(0, 999, 1 + d % 4))) for d in range(1000)]
    ids, keys = rng.integers(-9, 9, 1000), np.arange(1000)
    found = pa.Table.from_arrays(suffixes._found_columns(rows, ids, keys), schema=suffixes._FOUND)
    half = [suffixes._dealt(t, 8) for t in (found.slice(0, 700), found.slice(500))]
    assert [t.num_rows for t in half] == [8, 8] and suffixes._dealt(found.slice(0, 0), 8).num_rows == 0
    both = pa.concat_tables(half).combine_chunks()
    parts = [both.filter(pyarrow.compute.equal(both.column("part"), k)) for k in range(8)]
    got = pa.concat_tables([suffixes._gathered(t) for t in parts]).to_pylist()
    assert len(got) == 1000
    for row in got:
        twice = 1 + (500 <= row["_key"] < 700)
        _, low, high = rows[row["_key"]]
        assert row["_id"] == ids[row["_key"]] and row["_from"] == [*low] * twice and row["_to"] == [*high] * twice
