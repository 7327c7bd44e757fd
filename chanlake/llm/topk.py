"""Exact top-k by no-random-access aggregation of sorted lists.

Every dimension of a block of vectors is a list sorted by value. For a query the list of a
dimension is read from its large end where the query's component is positive, from its
small end where it is negative, so contributions come in falling order. After each round
of reads every candidate has a lower bound (its known parts plus the worst of each unread
list) and an upper bound (its known parts plus the next value of each unread list). A
query is done with a block once k candidates have lower bounds that no other candidate's
upper bound reaches; the known parts that are still missing of those k are then read on.
Rounds and bounds are computed for all queries of a block at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanlake.session import materialised

BLOCK_ROWS = 4096
QUERY_ROWS = 512
ROUNDS = (0.25, 0.5, 1.0)  # parts of every list that have been read after each round
SCALE = 256
_EXACT = float(1 << 53)  # float64 holds every whole number below


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``id, v``: floor of ``SCALE`` times each component, as array<long>.

    Null vectors, null ids and vectors with null or non-finite components are left out. Of rows
    with the same id the least vector stays. Shorter vectors count as padded with zeros.
    """
    values = F.col(column)
    finite = F.forall(
        values,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= F.lit(1.7e308)),
    )
    whole = F.transform(values, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("bigint"))
    kept = vectors.filter(F.col(id_column).isNotNull() & values.isNotNull() & finite)
    return kept.select(F.col(id_column).alias("id"), whole.alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _packed(rows: DataFrame, block_rows: int) -> DataFrame:
    """The rows of each task in blocks: ids and a row-major matrix of 64-bit numbers."""

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                ids, matrix = part.column(0), _matrix(part.column(1))
                row = {
                    "ids": np.asarray(ids, np.int64).tobytes(),
                    "width": matrix.shape[1],
                    "matrix": matrix.tobytes(),
                }
                yield pa.RecordBatch.from_pylist(
                    [row], pa.schema([("ids", pa.binary()), ("width", pa.int32()), ("matrix", pa.binary())])
                )

    return rows.select("id", "v").mapInArrow(pack, "ids binary, width int, matrix binary")


def _matrix(lists: pa.Array) -> np.ndarray:
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    width = int(sizes.max(initial=0))
    values = np.asarray(lists.flatten(), np.int64)
    matrix = np.zeros((len(sizes), width), np.int64)
    matrix[np.arange(width) < sizes[:, None]] = values
    return matrix


def _unpacked(ids: bytes, width: int, matrix: bytes, to: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    values = np.frombuffer(matrix, "<i8").reshape(len(own), width)
    return own, np.pad(values, ((0, 0), (0, to - width)))


def top_of_block(ids, vectors, query_ids, queries, k: int, rounds=ROUNDS):
    """``query, id, score`` arrays: the k best of a block for every query, not itself.

    Ties go to the smaller id. Scores are exact; where products could pass 2**53 they are
    computed with Python's whole numbers, and one beyond 64 bits is an OverflowError.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0))
    if largest * max(1, vectors.shape[1]) >= _EXACT:
        scores = vectors.astype(object) @ queries.T.astype(object)
        return _chosen(ids, scores.T, query_ids, k)
    n, width = vectors.shape
    values = vectors.astype(np.float64)
    rank = np.empty((n, width), np.int64)
    by_value = np.argsort(values, axis=0, kind="stable")
    np.put_along_axis(rank, by_value, np.arange(n)[:, None], axis=0)
    lists = np.take_along_axis(values, by_value, axis=0)
    positive, negative = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    open_, found = np.arange(len(queries)), []
    for part in rounds:
        depth = min(n, max(k + 1, int(np.ceil(part * n))))
        plus, minus = positive[open_], negative[open_]
        if depth == n:
            exact = (values @ (plus + minus).T).T
            found.append(_chosen(ids, exact, query_ids[open_], k))
            break
        top, bottom = rank >= n - depth, rank < depth
        known = np.where(top, values, 0) @ plus.T + np.where(bottom, values, 0) @ minus.T
        # unread entries lie between the end of the list and the next value to be read
        unread_top, unread_bottom = (~top).astype(float), (~bottom).astype(float)
        lower = known + unread_top @ (plus * lists[0]).T + unread_bottom @ (minus * lists[-1]).T
        upper = known + unread_top @ (plus * lists[n - depth - 1]).T + unread_bottom @ (minus * lists[depth]).T
        own = ids[:, None] == query_ids[open_][None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        best = np.argpartition(-lower, k - 1, axis=0)[:k] if n > k else np.tile(np.arange(n)[:, None], len(open_))
        worst = np.take_along_axis(lower, best, axis=0).min(axis=0)
        others = upper.copy()
        np.put_along_axis(others, best, -np.inf, axis=0)
        done = (others.max(axis=0) < worst) & np.isfinite(worst)
        for q in np.flatnonzero(done):  # the lists are read on for the k only
            members = np.sort(best[:, q])
            final = values[members] @ (plus + minus)[q]
            found.append(_chosen(ids[members], final[None, :], query_ids[open_[q : q + 1]], k))
        open_ = open_[~done]
        if not len(open_):
            break
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else _chosen(ids, np.zeros((0, n)), query_ids[:0], k)


def _chosen(ids, scores, query_ids, k: int):
    """The k best of each row of scores; ids are sorted, so a stable sort breaks ties."""
    chosen = []
    for row, query in zip(scores, query_ids, strict=True):
        near = np.arange(len(row))
        if len(row) > 8 * k and row.dtype != object:
            near = np.flatnonzero(row >= np.partition(row, len(row) - k - 1)[len(row) - k - 1])
        near = near[ids[near] != query]
        best = near[np.argsort(-row[near], kind="stable")[:k]]
        chosen += [(query, ids[i], int(row[i])) for i in best]
    return tuple(np.array([c[i] for c in chosen], np.int64) for i in range(3))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of every query.

    Both sides are ``id, v`` of ``quantised``. Candidates are packed in blocks and met by the
    queries in blocks, each pair of blocks once; a block of candidates is repeated for each
    block of queries, never a row for a row. A task gives k rows for each query and block.
    All candidates if there are fewer than k; no queries or no candidates, no rows.
    """
    spark = vectors.sparkSession
    blocks = -(-queries.count() // query_rows)
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sent = (
        queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        .groupBy("part")
        .agg(F.collect_list(F.struct("id", "v")).alias("rows"))  # about query_rows each, by hash
    )
    packed = materialised(_packed(vectors, block_rows), "blocks")
    meeting = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(sent, "part")

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                asked = pa.array([r["v"] for r in row["rows"]], pa.list_(pa.int64()))
                asked = _matrix(asked)
                width = max(row["width"], asked.shape[1])
                ids, values = _unpacked(row["ids"], row["width"], row["matrix"], width)
                asked = np.pad(asked, ((0, 0), (0, width - asked.shape[1])))
                query_ids = np.array([r["id"] for r in row["rows"]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in top_of_block(ids, values, query_ids, asked, k)],
                    names=["query_id", "vec_id", "score"],
                )

    each = meeting.select("ids", "width", "matrix", "rows").mapInArrow(
        work, "query_id long, vec_id long, score long"
    )
    # k rows for each query and block are left; each task keeps k of a query before the shuffle
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
