"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.llm.ranges import digest, range_count, running_total

UNITS = 256  # units of a shard: larger groups are packed alone, smaller ones in bundles
BLOCK = 512


class CapacityTree:
    """Open bins by remaining capacity: a two-level search tree whose leaves split in halves,
    so finding the tightest bin that fits, and moving a bin, cost about the root of the bins."""

    def __init__(self):
        self.leaves: list[list[tuple[int, int]]] = []

    def add(self, remaining: int, number: int) -> None:
        item = (remaining, number)
        if not self.leaves:
            self.leaves.append([item])
            return
        at = min(bisect.bisect_left(self.leaves, item, key=lambda leaf: leaf[-1]), len(self.leaves) - 1)
        leaf = self.leaves[at]
        bisect.insort(leaf, item)
        if len(leaf) > BLOCK:
            half = len(leaf) // 2
            self.leaves[at : at + 1] = [leaf[:half], leaf[half:]]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and give the bin with the least remaining capacity of at least ``size``."""
        at = bisect.bisect_left(self.leaves, (size, -1), key=lambda leaf: leaf[-1])
        if at == len(self.leaves):
            return None
        leaf = self.leaves[at]
        item = leaf.pop(bisect.bisect_left(leaf, (size, -1)))
        if not leaf:
            del self.leaves[at]
        return item


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of every item, bins numbered in the order they open. Items larger than the
    capacity get bins of their own. Ties go by position, so reruns agree."""
    tree, bins, placed = CapacityTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take_tightest(sizes[i])
        if found is None:
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        placed[i] = found[1]
        tree.add(found[0] - sizes[i], found[1])
    return placed


def pack_evenly(sizes: list[int], bins: int) -> list[int]:
    """Bins of near equal totals: an item above the mean of what is left gets a bin of its own,
    until there is none; best fit decreasing packs the rest into the remaining bins."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    left, own = sum(sizes), 0
    while own < min(bins - 1, len(order)) and sizes[order[own]] * (bins - own) > left:
        left -= sizes[order[own]]
        own += 1
    placed = [0] * len(sizes)
    for b, i in enumerate(order[:own]):
        placed[i] = b
    rest = order[own:]
    for i, b in zip(rest, _least_capacity([sizes[i] for i in rest], bins - own), strict=True):
        placed[i] = own + b
    return placed


def _least_capacity(sizes: list[int], bins: int) -> list[int]:
    """Best fit decreasing with the least capacity that needs no more than ``bins`` bins; bins
    it leaves empty take half of the fullest."""
    low, high = -(-sum(sizes) // bins), 2 * -(-sum(sizes) // bins) + max(sizes, default=0)
    low = max(low, max(sizes, default=0))
    best = best_fit_decreasing(sizes, high)
    while low < high:
        middle = (low + high) // 2
        trial = best_fit_decreasing(sizes, middle)
        if max(trial, default=0) < bins:
            best, high = trial, middle
        else:
            low = middle + 1
    return _fill_empty(sizes, best, bins)


def _fill_empty(sizes: list[int], placed: list[int], bins: int) -> list[int]:
    placed = list(placed)
    for empty in range(max(placed, default=-1) + 1, bins):
        items: list[list[int]] = [[] for _ in range(empty)]
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            items[placed[i]].append(i)
        several = [own for own in items if len(own) > 1]
        if not several:
            break
        halves = [0, 0]
        for i in max(several, key=lambda own: sum(sizes[i] for i in own)):
            half = halves.index(min(halves))
            halves[half] += sizes[i]
            if half:
                placed[i] = empty
    return placed


def text_bytes(text: str) -> Column:
    """UTF-8 bytes plus 1; null has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def shard(docs: DataFrame, shards: int = 16, units: int = UNITS) -> DataFrame:
    """Every row with ``size`` (bytes), ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless
    from 0 in each shard), shards nearly equal in bytes.

    Equal texts (null as empty) are a group and never divided. A group above 1 in ``units``
    of a mean shard is packed alone: there are fewer than ``shards * units`` of those. All
    others go by a hash of the text into as many bundles, which are packed in their stead;
    so at most twice ``shards * units`` sizes reach the driver, however large the input. A
    group above the mean of what is left fills a shard alone and the rest shares the other
    shards evenly. Texts with equal 64-bit hashes count as one group. Empty in, empty out; existing columns of the
    names added are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("size", "shard", "slot")
    docs = docs.withColumn("size", text_bytes("text")).withColumn(
        "_group", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    groups = docs.groupBy("_group").agg(F.sum("size").alias("size"))
    total = docs.agg(F.sum("size")).first()[0] or 0
    least = total / (shards * units)
    bundle = F.pmod(F.xxhash64("_group"), F.lit(shards * units)).cast("bigint")
    is_large = F.col("size") > least
    packed = (
        groups.select(
            F.when(is_large, F.col("_group")).alias("_alone"), F.when(~is_large, bundle).alias("_bundle"), "size"
        )
        .groupBy("_alone", "_bundle")
        .agg(F.sum("size").alias("size"))
        .collect()
    )
    packed.sort(key=lambda r: (r.size, r._alone is None, r._alone or 0, r._bundle or 0), reverse=True)
    bins = pack_evenly([r.size for r in packed], shards)
    alone = [(r._alone, b) for r, b in zip(packed, bins, strict=True) if r._alone is not None]
    bundled = [(r._bundle, b) for r, b in zip(packed, bins, strict=True) if r._alone is None]
    alone = spark.createDataFrame(alone, "_group long, _own int")
    bundled = spark.createDataFrame(bundled, "_bundle long, _shared int")
    # both lists have fewer rows than shards * units
    placed = (
        docs.withColumn("_bundle", bundle)
        .join(F.broadcast(alone), "_group", "left")
        .join(F.broadcast(bundled), "_bundle", "left")
        .withColumn("shard", F.coalesce("_own", "_shared"))
        .drop("_own", "_shared", "_bundle")
    )
    return with_slots(placed.drop("_group"), docs.count())


def with_slots(placed: DataFrame, rows: int) -> DataFrame:
    """Add ``slot``, the place in the shard in the order of a digest of the row's id and text."""
    ordered = placed.withColumn("_order", digest("doc_id")).withColumn("_tie", F.xxhash64("doc_id", "text"))
    slotted = running_total(ordered, ["shard"], ["_order", "_tie"], F.lit(1), "slot", range_count(rows))
    return slotted.withColumn("slot", F.col("slot").cast("bigint")).drop("_order", "_tie")
