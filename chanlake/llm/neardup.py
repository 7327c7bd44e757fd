"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has SYMBOLS MinHash values of 16 bits. Its distance to another is the number of
symbols that differ. Signatures are cut into CHUNKS; by the pigeonhole principle two
signatures within DISTANCE agree, in some chunk, but for at most DISTANCE // CHUNKS symbols.
Every way to leave that many symbols out of every chunk is a key, so all pairs within
DISTANCE share a key. At a similarity of 0.85 a symbol differs with probability 0.15; that
more than 28 of 64 do has probability 1e-8. At 0.8 more than 29 do with probability 1e-6,
and 15 chunks still allow one error each, so the keys are the same. Pairs of one key are compared by signature, and
what is within DISTANCE is confirmed on the full shingle sets.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm.components import connected
from chanlake.llm.words import combine, mix, pieces, row_of, word_hashes
from chanlake.session import materialised, scratch

SHINGLE = 5
THRESHOLD = (85, 100)  # links: 100 * intersection >= 85 * union
SYMBOLS, CHUNKS, DISTANCE = 64, 15, 28
LOWEST = {28: (85, 100), 29: (80, 100)}  # the least similarity that a distance is made for
BLOCK = 128  # documents of a block of a large candidate group
_SEED = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = mix(_SEED) | np.uint64(1)


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in rising order, and their numbers.

    A text of fewer words, but not none, is one shingle.
    """
    words, counts = word_hashes(texts)
    row = row_of(counts)
    starts = np.cumsum(counts) - counts
    place = np.arange(len(words)) - starts[row]
    length = np.minimum(counts, width)[row]
    begins = place + length <= counts[row]
    begins &= (place == 0) | (counts[row] > width)
    at = np.flatnonzero(begins)
    hashes = words[at].copy()
    for k in range(1, width):
        longer = length[at] > k
        hashes[longer] = combine(hashes[longer], words[at[longer] + k])
    rows = row[at]
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], np.bincount(rows[new], minlength=len(counts))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc, n_shingles, set_a, set_b, sig`` of ``doc, text``; the two sums name the set."""

    def work(batches):
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                hashes, sizes = shingles(piece.column(1))
                filled = np.flatnonzero(sizes)
                at = (np.cumsum(sizes) - sizes)[filled]
                sums = np.zeros((2, len(sizes)), np.uint64)
                symbols = np.zeros((len(sizes), SYMBOLS), np.uint16)
                if len(filled):
                    sums[0, filled] = np.add.reduceat(mix(hashes), at)
                    sums[1, filled] = np.add.reduceat(mix(hashes ^ _SEED[0]), at)
                    for k in range(SYMBOLS):
                        least = np.minimum.reduceat((hashes ^ _SEED[k]) * _ODD[k], at)
                        symbols[filled, k] = mix(least) & np.uint64(0xFFFF)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.array([s.tobytes() for s in symbols], pa.binary()),
                    ],
                    names=["doc", "n_shingles", "set_a", "set_b", "sig"],
                )

    schema = "doc long, n_shingles long, set_a long, set_b long, sig binary"
    return docs.select("doc", "text").mapInArrow(work, schema)


def _key_columns() -> list[tuple[int, ...]]:
    """The symbols of every key: each chunk without each choice of its allowed errors."""
    bounds = [SYMBOLS * c // CHUNKS for c in range(CHUNKS + 1)]
    errors = DISTANCE // CHUNKS
    return [
        tuple(sorted(set(range(low, high)) - set(left_out)))
        for low, high in zip(bounds, bounds[1:], strict=False)
        for left_out in combinations(range(low, high), errors)
    ]


def _symbols(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), SYMBOLS)


def index_keys(sets: DataFrame) -> DataFrame:
    """``key, doc``: the keys of every signature."""
    wanted = _key_columns()

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                symbols = _symbols(part.column(1)).astype(np.uint64)
                keys = np.empty((len(wanted), part.num_rows), np.uint64)
                for k, columns in enumerate(wanted):
                    own = np.full(part.num_rows, k, np.uint64)
                    for column in columns:
                        own = combine(own, symbols[:, column])
                    keys[k] = own
                docs = np.tile(np.asarray(part.column(0)), len(wanted))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(docs)], names=["key", "doc"]
                )

    return sets.select("doc", "sig").mapInArrow(work, "key long, doc long")


def _close(pairs: DataFrame, sets: DataFrame, distance: int) -> DataFrame:
    """Those of ``a, b`` whose signatures are within ``distance``."""
    sigs = sets.select("doc", "sig")
    both = pairs.join(sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b")), "b"
    )

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                far = (_symbols(batch.column(2)) != _symbols(batch.column(3))).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [c.filter(pa.array(far <= distance)) for c in batch.columns[:2]], names=["a", "b"]
                )

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(work, "a long, b long")


def candidate_groups(sets: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``node, component`` of the graph of all signatures within ``distance`` of each other.

    Keys with the same members are compared once. Members of a key are first compared with
    the least of them; only keys whose members are not all connected by then, by whatever
    key, are compared in full. So a large group of copies costs rows, not pairs.
    """
    keys = materialised(index_keys(sets), "keys")
    code = F.xxhash64("doc").cast("decimal(20,0)")
    by_key = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high"), F.sum(code).alias("code")
    )
    groups = materialised(
        by_key.filter("n > 1").groupBy("n", "low", "high", "code").agg(F.min("key").alias("key")), "groups"
    )
    members = materialised(
        keys.join(groups.filter("n > 2").select("key", "low"), "key").select("key", "low", "doc"), "members"
    )
    stars = members.filter("doc <> low").select(F.col("doc").alias("a"), F.col("low").alias("b"))
    twos = groups.filter("n = 2").select(F.col("high").alias("a"), F.col("low").alias("b"))
    close = materialised(_close(stars.unionByName(twos).distinct(), sets, distance), "close")
    joined = connected(close)
    placed = members.join(joined, F.col("doc") == F.col("node"), "left").select(
        "key", "doc", F.coalesce("component", "doc").alias("component")
    )
    placed = materialised(placed, "placed")
    open_keys = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).filter("x <> y")
    rest = placed.join(open_keys.select("key", "n"), "key").join(sets.select("doc", "sig"), "doc")
    more = _block_groups(rest, "key", "n", 8 * BLOCK).groupBy("part", "i", "j").applyInArrow(
        _close_in_group(distance), "a long, b long"
    )
    return connected(close.unionByName(more))


def _block_groups(rows: DataFrame, group: str, n: str, block: int) -> DataFrame:
    """Add ``part, i, j``: groups of bounded size in which all pairs of a group meet.

    Small groups share parts. A larger group is dealt by hash into blocks, and its rows go
    to every pair of blocks that has theirs, so a pair of documents meets in some part.
    """
    blocks = F.greatest(F.ceil(F.col(n) / block), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("_blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    pairs = F.transform(others, lambda o: F.struct(F.least(o, F.col("_own")).alias("i"), F.greatest(o, F.col("_own")).alias("j")))
    # a block meets itself with any other, so it needs no pair of its own
    pairs = F.when(F.col("_blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.filter(pairs, lambda p: p["i"] != p["j"])
    )
    return (
        rows.withColumn("_blocks", blocks)
        .withColumn("_own", own)
        .withColumn("_pair", F.explode(pairs))
        .withColumn("part", F.col(group))
        .withColumn("i", F.col("_pair.i"))
        .withColumn("j", F.col("_pair.j"))
        .drop("_blocks", "_own", "_pair")
    )


def _close_in_group(distance: int):
    def work(table: pa.Table) -> pa.Table:
        """Links that connect what is within ``distance`` in a group, searched from each row to
        all rows not reached yet."""
        table = table.combine_chunks()
        docs = np.asarray(table["doc"])
        symbols = _symbols(table["sig"])
        return _forest(docs, lambda i, rest: (symbols[rest] != symbols[i]).sum(axis=1) <= distance)

    return work


def _forest(docs: np.ndarray, near) -> pa.Table:
    """Links of a spanning forest; ``near(i, rest)`` tells which of ``rest`` link with ``i``."""
    rest, links = np.arange(len(docs)), []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            hit = near(i, rest)
            links += [(docs[i], docs[j]) for j in rest[hit]]
            todo += rest[hit].tolist()
            rest = rest[~hit]
    return pa.table(
        {"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())}
    )


def _full_sets(docs: DataFrame) -> DataFrame:
    """``doc, component, n, set``: the shingles themselves as bytes."""

    def work(batches):
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                hashes, sizes = shingles(piece.column(3))
                bounds = np.append(0, np.cumsum(sizes))
                sets = [hashes[x:y].tobytes() for x, y in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[:3], pa.array(sets, pa.binary())], names=["doc", "component", "n", "set"]
                )

    return docs.select("doc", "component", "n", "text").mapInArrow(work, "doc long, component long, n long, set binary")


def _linked_in_group(over: int, under: int):
    def work(table: pa.Table) -> pa.Table:
        """Links of a spanning forest of the documents of each component that truly link."""
        table = table.combine_chunks()
        components = np.asarray(table["component"])
        order = np.argsort(components, kind="stable")
        bounds = np.flatnonzero(np.append(True, components[order][1:] != components[order][:-1]))
        found = []
        docs, sets = np.asarray(table["doc"]), table["set"]
        for pick in np.split(order, bounds[1:]):
            own = [np.frombuffer(sets[int(i)].as_py(), "<u8") for i in pick]
            found.append(_forest(docs[pick], _similar(own, over, under)))
        return pa.concat_tables(found)

    return work


def _similar(sets: list[np.ndarray], over: int, under: int):
    """Exact similarity of one set with many: shingles as numbers, the one set as a mask."""
    sizes = np.array([len(s) for s in sets])
    distinct, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mask = np.zeros(len(distinct), bool)

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        fits = (under * np.minimum(sizes[rest], sizes[i]) >= over * np.maximum(sizes[rest], sizes[i]))
        hit = np.zeros(len(rest), bool)
        picked = rest[fits]
        if len(picked):
            mask[numbers[starts[i] : ends[i]]] = True
            where = np.repeat(starts[picked] - np.cumsum(sizes[picked]) + sizes[picked], sizes[picked])
            inside = mask[numbers[where + np.arange(len(where))]]
            common = np.add.reduceat(inside.astype(np.int64), np.cumsum(sizes[picked]) - sizes[picked])
            mask[numbers[starts[i] : ends[i]]] = False
            hit[fits] = under * common >= over * (sizes[picked] + sizes[i] - common)
        return hit

    return near


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    threshold: tuple[int, int] = THRESHOLD,
    distance: int = DISTANCE,
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents whose sets have the threshold's similarity are linked; ``component_id`` is the
    smallest reachable id and ``kept`` says that it is the row's own. Null, empty and blank
    texts have no shingles and link with nothing. Equal sets are one class, represented by
    its smallest id. Ids have to be unique whole numbers: rows that share an id are treated
    as one document, and rows without an id are kept and linked with nothing. A distance of
    28 finds similarities from 0.85 on, one of 29 those from 0.8 on; a lower threshold, or
    another distance, is refused.
    """
    over, under = threshold
    if distance not in LOWEST:
        raise ValueError("the keys are dimensioned for distances of 28 and 29")
    least, of = LOWEST[distance]
    if of * over < least * under:
        raise ValueError(f"a distance of {distance} is dimensioned for similarities of {least / of} and more")
    with scratch(docs.sparkSession):
        texts = docs.select(F.col(id_column).cast("bigint").alias("doc"), "text")
        signed = materialised(signatures(texts), "signatures")
        sets = materialised(
            signed.filter("n_shingles > 0 AND doc IS NOT NULL")
            .groupBy("set_a", "set_b", "n_shingles")
            .agg(F.min("doc").alias("doc"), F.first("sig").alias("sig")),
            "sets",
        )
        groups = candidate_groups(sets, distance)
        sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
        members = materialised(groups.join(sizes, "component").withColumnRenamed("node", "doc"), "groups")
        full = _full_sets(texts.join(members, "doc"))
        parts = F.lit(max(1, members.count() // BLOCK))
        small = F.pmod(F.xxhash64("component"), parts)
        blocked = _block_groups(full, "component", "n", BLOCK).withColumn(
            "part", F.when(F.col("n") > BLOCK, F.col("part")).otherwise(-1 - small)
        )
        links = materialised(
            blocked.select("part", "i", "j", "component", "doc", "set")
            .groupBy("part", "i", "j")
            .applyInArrow(_linked_in_group(over, under), "a long, b long"),
            "linked",
        )
        linked = connected(links)
        classes = sets.join(linked, F.col("doc") == F.col("node"), "left").select(
            "set_a", "set_b", "n_shingles", F.coalesce("component", "doc").alias("component_id")
        )
        found = signed.join(classes, ["set_a", "set_b", "n_shingles"], "left")
        component = F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc"))
        result = found.select(
            F.col("doc").alias(id_column),
            "n_shingles",
            component.alias("component_id"),
            component.eqNullSafe(F.col("doc")).alias("kept"),
        )
        return materialised(result, "near-duplicates", keep=True)
