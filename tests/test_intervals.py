"""Seen messages as intervals: little state, the same result as a batch job, over restarts."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd

from chanlake.streaming.intervals import from_state, one_of_each, state_of, unseen, with_ids
from chanlake.streaming.messages import dedup_stream


def test_intervals_against_a_set():
    rng = random.Random(4)
    starts = ends = np.zeros(0, np.int64)
    seen = set()
    for _ in range(60):
        ids = np.array(sorted({rng.randrange(-40, 200) for _ in range(rng.randrange(8))}), np.int64)
        fresh = unseen(ids, starts, ends)
        assert ids[fresh].tolist() == [i for i in ids.tolist() if i not in seen]
        starts, ends = with_ids(ids[fresh], starts, ends)
        seen |= set(ids.tolist())
        assert sorted(i for a, b in zip(starts, ends, strict=True) for i in range(a, b + 1)) == sorted(seen)
        assert (starts[1:] > ends[:-1] + 1).all()


def test_a_million_ids_in_order_are_one_interval():
    starts = ends = np.zeros(0, np.int64)
    for at in range(0, 1_000_000, 50_000):
        starts, ends = with_ids(np.arange(at, at + 50_000), starts, ends)
    assert (starts.tolist(), ends.tolist()) == ([0], [999_999])


def test_a_state_is_no_larger_than_a_bitmap():
    none = np.zeros(0, np.int64)
    for first in (-(1 << 20), 0, 5 << 20):
        for ids in (none, first + np.arange(0, 1 << 20, 4), first + np.arange(1 << 20), first + np.array([0, 7, (1 << 20) - 1])):
            given = with_ids(ids, none, none)
            state = state_of(*given, first)
            assert len(state[0]) + len(state[1]) <= 16_384
            assert all(a.tolist() == b.tolist() for a, b in zip(from_state(*state, first), given, strict=True))
    old = ([0, 8], [3, 9])  # as stored before there were bitmaps
    assert [v.tolist() for v in from_state(*old, 0)] == [*old]


def test_one_row_for_each_id_whatever_the_order():
    batch = pd.DataFrame({"id": [5, 1, 5, 2, 1], "row": ["b", "z", "a", "c", "y"]})
    for order in ([0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [2, 0, 4, 1, 3]):
        kept = one_of_each(batch.iloc[order])
        assert sorted(zip(kept["id"], kept["row"], strict=True)) == [(1, "y"), (2, "c"), (5, "a")]


def test_a_stream_equals_a_batch_over_restarts(spark, tmp_path):
    rng = random.Random(2)
    when = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    fields = "channel_id string, id long, text string, date timestamp, tags array<string>, n struct<big:bigint,x:double>"
    raw, out, state = (str(tmp_path / name) for name in ("raw", "out", "state"))
    given = set()
    for part in range(4):
        rows = []
        for _ in range(200):
            c, i = rng.choice(["a", "b"]), rng.choice([rng.randrange(150), 2**40 + rng.randrange(50)])
            rows.append((c, i, f"{c}{i}\u00e9", when if i % 3 else None, [str(i)], (2**60 + i, i / 7)))
        rows += [(None, 1, "no channel", None, None, None), ("a", None, "no id", None, None, None)]
        given |= {(r[0], r[1]) for r in rows if None not in r[:2]}
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(raw)
        query = (  # a new query from the checkpoint for each part
            dedup_stream(spark.readStream.schema(fields).parquet(raw)).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    got = spark.read.parquet(out)
    source = spark.read.parquet(raw).filter("channel_id IS NOT NULL AND id IS NOT NULL")
    assert {(r.channel_id, r.id) for r in got.collect()} == given and got.count() == len(given)
    assert got.schema == spark.read.schema(fields).parquet(raw).schema
    assert got.exceptAll(source.dropDuplicates(["channel_id", "id"])).count() == 0  # values are unchanged
