"""Remembering which messages a stream has seen, in little state.

Ids of a channel's messages grow one by one, so those that were seen are few intervals, however
many they are. A state is kept for each channel and block of a million ids: a channel with much of
the traffic is many states. Where ids have many gaps, so that the intervals would be more than a
bitmap of the block, the state is that bitmap: no state has more than 16,384 numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from chanlake.session import ship_package

BLOCK_BITS = 20
BLOCK = 1 << BLOCK_BITS
WORDS = BLOCK // 64
# Intervals, or the words of a bitmap as ``starts`` without ``ends``.
STATE = "starts array<bigint>, ends array<bigint>"
_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def unseen(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which ids lie in none of the intervals (ends included, in order and apart)."""
    at = np.searchsorted(starts, ids, "right") - 1
    if not len(starts):
        return np.ones(len(ids), bool)
    return (at < 0) | (ids > ends[np.maximum(at, 0)])


def with_ids(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals with these ids; neighbours become one."""
    low, high = np.concatenate([starts, ids]), np.concatenate([ends, ids])
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order]) if len(order) else high
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1] + 1
    first = np.flatnonzero(new)
    return low[first], high[np.append(first[1:], len(low))[: len(first)] - 1]


def one_of_each(batch: pd.DataFrame) -> pd.DataFrame:
    """A row for each id; of several the first as text, whatever their order. Only these are sorted."""
    several = batch["id"].duplicated(keep=False)
    if not several.any():
        return batch
    chosen = batch[several].sort_values(["id", "row"]).drop_duplicates("id")
    return pd.concat([batch[~several], chosen])


def bitmap(starts: np.ndarray, ends: np.ndarray, first: int) -> np.ndarray:
    """A flag for each id of the block that begins with ``first``: whether it lies in the intervals."""
    steps = np.zeros(BLOCK + 1, np.int8)
    steps[starts - first] += 1
    steps[ends + 1 - first] -= 1
    return np.cumsum(steps[:-1], dtype=np.int8).astype(bool)


def intervals(seen: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """The intervals that ``bitmap`` gives these flags for."""
    steps = np.diff(seen.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps == 1) + first, np.flatnonzero(steps == -1) - 1 + first


def state_of(starts: np.ndarray, ends: np.ndarray, first: int) -> tuple[list[int], list[int]]:
    """What is stored for the intervals: them, or the words of their bitmap if these are fewer."""
    if 2 * len(starts) <= WORDS:
        return starts.tolist(), ends.tolist()
    return np.packbits(bitmap(starts, ends, first), bitorder="little").view("<i8").tolist(), []


def from_state(starts: list[int], ends: list[int], first: int) -> tuple[np.ndarray, np.ndarray]:
    """The intervals of a stored state."""
    stored = np.array(starts, "<i8")
    if len(starts) == len(ends):
        return stored.astype(np.int64), np.array(ends, np.int64)
    return intervals(np.unpackbits(stored.view(np.uint8), bitorder="little"), first)


def _keep_first(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    first = int(key[1]) << BLOCK_BITS
    starts, ends = from_state(*(state.get if state.exists else ([], [])), first)
    grown = False
    for batch in batches:
        batch = one_of_each(batch)
        ids = batch["id"].to_numpy(np.int64)
        fresh = unseen(ids, starts, ends)
        if fresh.any():
            starts, ends = with_ids(ids[fresh], starts, ends)
            grown = True
        yield batch.loc[fresh, ["row"]]
    if grown:  # messages that were all seen leave the state as it is stored
        state.update(state_of(starts, ends, first))


def first_readings(messages: DataFrame) -> DataFrame:
    """Rows of a stream whose ``channel_id, id`` did not come before.

    Rows pass through as JSON, so that their values keep their types. Rows without a key are not
    messages and are left out.
    """
    ship_package(messages.sparkSession)
    schema: StructType = messages.schema
    row = F.to_json(F.struct(*messages.columns), _MICROS).alias("row")
    keyed = messages.filter("channel_id IS NOT NULL AND id IS NOT NULL").select(
        F.col("channel_id").cast("string").alias("channel_id"), F.shiftright(F.col("id").cast("bigint"), BLOCK_BITS).alias("block"),
        F.col("id").cast("bigint").alias("id"), row,
    )
    kept = keyed.groupBy("channel_id", "block").applyInPandasWithState(
        _keep_first, "row string", STATE, "append", GroupStateTimeout.NoTimeout
    )
    return kept.select(F.from_json("row", schema, _MICROS).alias("row")).select("row.*")
