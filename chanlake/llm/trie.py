"""The trie of all conversations by their leading turns, with what caching shared prefixes saves.

A node is a distinct sequence of leading turns; conversations that start with it are its members.
Each prefix has a digest. A count-min sketch of the digests never counts too few, so a prefix
that it counts once belongs to one conversation, and so do all longer ones of it: this tail is a
chain of nodes, given out where it stands. Only prefixes that may be shared go through a shuffle,
to be grouped exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chanlake.llm.mixing import word_count
from chanlake.llm.ship import ship
from chanlake.llm.words import groups, mix
from chanlake.session import materialised, shared_dir

HASHES = 4  # rows of the sketch
WIDTHS = (1 << 12, 1 << 22)  # least and largest number of counters in one; the sketch has 16 MB at most
PART = 1 << 16  # counters sent together
SHARED, HEAD, TAIL = 0, 1, 2  # a prefix that may be shared; the first of a tail; the rest of it
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, a, b, words``: turns as a 128 bit digest of role and text, and the words
    of the text, in the order of ``turn`` (null first; ties by the digest).

    A null role or text counts as an empty one. Rows without ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    slim = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"), word_count(text).alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    return slim.select("conv_id", F.row_number().over(order).cast("bigint").alias("position"), "a", "b", "words")


def opening_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its block, 0 to 3."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def with_borrowed_openings(turns: DataFrame, block: int = 20) -> DataFrame:
    """Each conversation with its first turns replaced by those of the conversation that its block
    of ids starts with (by as many as that one has, none if there is none).

    Gives a row at depth 0 for each conversation, and its turns from depth 1 on.
    """

    def start(c: Column) -> Column:
        return c - c % block

    own = turns.withColumn("_block", start(F.col("conv_id")))
    near = F.sequence(F.lit(1 - block), F.lit(block - 1))
    lent = own.filter((F.col("conv_id") == F.col("_block")) & (F.col("position") < 4))
    lent = lent.withColumn("_step", F.explode(near)).withColumn("conv_id", F.try_add("_block", "_step")).drop("_step")
    lent = lent.filter((start(F.col("conv_id")) == F.col("_block")) & (opening_turns(F.col("conv_id")) >= F.col("position")))
    kept = own.filter(F.col("position") > opening_turns(F.col("conv_id")))
    roots = own.filter("position = 1").withColumns({"position": F.lit(0).cast("bigint"), "words": F.lit(0).cast("bigint")})
    parts = [df.withColumn("_part", F.lit(k)) for k, df in enumerate((roots, lent, kept))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    order = Window.partitionBy("conv_id").orderBy("_part", "position")
    # borrowed turns alone make no conversation: the row at depth 0 comes first if there is one
    there = rows.withColumns({"_own": F.min("_part").over(order), "depth": (F.row_number().over(order) - 1).cast("bigint")})
    return there.filter("_own = 0").select("conv_id", "depth", "a", "b", "words")


def _prefixes(rows: DataFrame) -> DataFrame:
    """``conv_id, depth, hi, lo, words, is_end``: the digest of each prefix as two numbers.

    It is the exclusive or of a digest of each turn with its place, so it runs along a
    conversation without holding it; the root has 0.
    """
    order = Window.partitionBy("conv_id").orderBy("depth")
    at_root = F.col("depth") == 0
    lanes = {
        "hi": F.bit_xor(F.when(at_root, F.lit(0)).otherwise(F.xxhash64("depth", "a", "b"))).over(order),
        "lo": F.bit_xor(F.when(at_root, F.lit(0)).otherwise(F.xxhash64("b", "depth", "a"))).over(order),
        "is_end": F.lead("depth").over(order).isNull(),
    }
    return rows.withColumns(lanes).select("conv_id", "depth", "hi", "lo", "words", "is_end")


def _counters(hi: np.ndarray, lo: np.ndarray, width: int) -> np.ndarray:
    """The counter of each digest in each row of the sketch, as a place in the whole of it."""
    hi, lo = hi.astype(np.int64).view(np.uint64), lo.astype(np.int64).view(np.uint64)
    rows = [mix(hi + mix(lo + np.uint64(k))) % np.uint64(width) + np.uint64(k * width) for k in range(HASHES)]
    return np.stack(rows).astype(np.int64)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _count(width: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(HASHES * width, np.uint8)  # 2 stands for more
        for batch in batches:
            for row in _counters(_numbers(batch, "hi"), _numbers(batch, "lo"), width):
                at, times = np.unique(row, return_counts=True)
                sketch[at] = np.minimum(sketch[at] + np.minimum(times, 2), 2)
        yield from _sent({k: sketch[k * PART : (k + 1) * PART] for k in range(-(-len(sketch) // PART))})

    return count


def _sent(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for k, counters in parts.items():
        if counters.any():
            block = pa.array([pa.compress(counters.tobytes(), "zstd", asbytes=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), block], ["part", "counters"])


def _added(width: int) -> Callable:
    size = min(PART, HASHES * width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, block in zip(batch.column("part").to_pylist(), batch.column("counters"), strict=True):
                own = np.frombuffer(pa.decompress(block.as_buffer(), size, "zstd"), np.uint8)
                parts[part] = np.minimum(parts[part] + own, 2) if part in parts else own
        yield from _sent(parts)

    return add


def sketch_of(prefixes: DataFrame, width: int) -> np.ndarray:
    """The count-min sketch of all prefixes but the root. Its size does not depend on their number
    beyond ``WIDTHS``; the driver gets the sketch only."""
    own = prefixes.filter("depth > 0").select("hi", "lo").mapInArrow(_count(width), "part int, counters binary")
    merged = own.repartition("part").mapInArrow(_added(width), "part int, counters binary")
    sketch = np.zeros(HASHES * width, np.uint8)
    for row in merged.collect():
        counters = np.frombuffer(pa.decompress(row.counters, min(PART, len(sketch)), "zstd", asbytes=True), np.uint8)
        sketch[row.part * PART : row.part * PART + len(counters)] = counters
    return sketch


def _marker(sketch, width: int) -> Callable:
    """Adds ``kind``; a task's rows are whole conversations, one after the other, by depth."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_depth, alone = None, -1, False
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, depth = _numbers(batch, "conv_id"), _numbers(batch, "depth")
            before = np.append(last_depth, depth[:-1])
            same = np.append(last is not None and conv[0] == last, conv[1:] == conv[:-1])
            if (depth != np.where(same, before + 1, 0)).any():
                raise RuntimeError("a conversation is not in one piece")
            counted = sketch.value[_counters(_numbers(batch, "hi"), _numbers(batch, "lo"), width)].min(0)
            single = (counted == 1) & (depth > 0)
            total = np.cumsum(single) + bool(alone and same[0])
            start = np.maximum.accumulate(np.where(depth == 0, np.arange(len(depth)), 0))
            floor = np.where(depth[start] == 0, total[start], 0)  # a root counts as nothing itself
            seen = total - single - floor > 0
            kind = np.where(seen, TAIL, np.where(single, HEAD, SHARED)).astype(np.int32)
            last, last_depth, alone = conv[-1], depth[-1], bool(kind[-1] != SHARED)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind)], [*batch.schema.names, "kind"])

    return mark


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of the ids of each node, which come in order; none are held."""
    node, digest = None, None

    def row(node, digest) -> pa.RecordBatch:
        columns = [*(pa.array([v], pa.int64()) for v in node), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, ["depth", "hi", "lo", "ends_sha256"])

    for batch in batches:
        nodes = np.stack([_numbers(batch, c) for c in ("depth", "hi", "lo")], 1)
        ids = _numbers(batch, "conv_id")
        for low, high in zip(*groups(nodes), strict=True):
            own, text = tuple(nodes[low].tolist()), ",".join(map(str, ids[low:high].tolist()))
            if own == node:
                digest.update(f",{text}".encode())
                continue
            if node:
                yield row(node, digest)
            node, digest = own, hashlib.sha256(text.encode())
    if node:
        yield row(node, digest)


def _checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` in the shared folder, its partitions and their order kept."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def prefix_trie(rows: DataFrame) -> DataFrame:
    """A row for each node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (the
    smallest member of its parent; null for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (childless nodes of its subtree, itself included), ``saved_tokens`` (over the same
    subtree, the words of each node's last turn times its members but one) and ``ends_sha256`` (of
    the ids, ascending and joined by commas, of members that end here).

    ``rows``: ``conv_id, depth, a, b, words``, for each conversation a row at depth 0 and its turns
    from 1 on, such as :func:`with_borrowed_openings` gives; ids are not null and no pair of id and
    depth comes twice. Without rows there are no nodes.

    A conversation's digests run through one task, its texts do not. Prefixes of any number of
    members are added up before they are shuffled; members that end at one node are digested in
    order by one task, which holds none of them.
    """
    spark = ship(rows.sparkSession)
    prefixes = _checkpointed(spark, _prefixes(rows))
    count = prefixes.count()
    width = WIDTHS[0]
    while width < min(4 * count, WIDTHS[1]):
        width *= 2
    sketch = spark.sparkContext.broadcast(sketch_of(prefixes, width))
    fields = "conv_id bigint, depth bigint, hi bigint, lo bigint, words bigint, is_end boolean, kind int"
    marked = materialised(prefixes.mapInArrow(_marker(sketch, width), fields), "prefixes")

    node = ["depth", "hi", "lo"]
    shared = marked.filter(F.col("kind") == SHARED).drop("kind")
    top = shared.filter("depth = 0").agg(F.min("conv_id").alias("first"), F.bool_and("is_end").alias("leaf")).first()
    root = {"first": F.lit(top["first"]).cast("bigint"), "leaf": F.lit(top["leaf"]).cast("boolean")}
    members = shared.filter("depth > 0").groupBy(*node).agg(
        F.min("conv_id").alias("first"), F.bool_and("is_end").alias("leaf")
    )
    placed = shared.filter("depth > 0").join(members, node).unionByName(shared.filter("depth = 0").withColumns(root))
    heads = marked.filter(F.col("kind") == HEAD).drop("kind").withColumns({"first": F.col("conv_id"), "leaf": F.lit(True)})
    placed = placed.withColumn("head", F.lit(False)).unionByName(heads.withColumn("head", F.lit(True)))

    along = Window.partitionBy("conv_id").orderBy("depth")
    rest = along.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    is_first = F.col("first") == F.col("conv_id")
    # a conversation stands for the leaf it ends in if it is that leaf's first, and for a tail always
    leaf = (F.col("head") | (F.col("is_end") & F.col("leaf") & is_first)).cast("bigint")
    walked = placed.withColumns({
        "parent": F.lag("first").over(along),
        "child": (F.lead("first").over(along) == F.col("conv_id")).cast("bigint"),
        "leaves": F.max(leaf).over(rest),
        "saved": F.sum(F.when(is_first, F.lit(0)).otherwise(F.col("words"))).over(rest),
    })
    ends = shared.filter("is_end").select(*node, "conv_id").repartition(*node).sortWithinPartitions(*node, "conv_id")
    ends = ends.mapInArrow(_ends, "depth bigint, hi bigint, lo bigint, ends_sha256 string")
    nodes = walked.filter("NOT head").groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"), F.min("parent").alias("parent_conv_id"), F.count("*").alias("n_convs"),
        F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"), F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    nodes = nodes.join(ends, node, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))

    def alone(rows: DataFrame, parent: Column) -> DataFrame:
        """Nodes of one conversation."""
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        own = F.when(F.col("is_end"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(NO_ENDS))
        return rows.select(
            "conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"),
            F.when(F.col("is_end"), none).otherwise(one).alias("n_children"), one.alias("n_leaves"),
            none.alias("saved_tokens"), own.alias("ends_sha256"),
        )

    first = alone(walked.filter("head"), F.col("parent"))
    tails = alone(marked.filter(F.col("kind") == TAIL), F.col("conv_id"))
    return nodes.select(*tails.columns).unionByName(first).unionByName(tails)
