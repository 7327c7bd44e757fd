"""Interpolated modified Kneser-Ney language models: counted in Spark, kept as sorted hash
arrays in the shared folder, mapped into memory by the workers that score texts.

Every n-gram of order m is a hash of its context and a hash of its word. Tasks count their
own n-grams in numpy and send sorted blocks to the bucket of the context, so the shuffle
moves arrays, not rows. Contexts with more n-grams than a mean bucket are dealt to several
buckets by word; only for those do partial context totals pass the driver (at most two per
bucket). The reduced buckets are the model: no gram of any order is dropped.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm.ship import extended
from chanlake.llm.words import combine, mix, pieces, row_sums, word_hashes
from chanlake.session import shared_dir

BEGIN = np.uint64(0x243F6A8885A308D3)  # before the first word of a text
END = np.uint64(0x13198A2E03707344)  # after the last word; counted as a token
ORDER = 2
BUCKET_TOKENS = 2_000_000  # mean tokens of a bucket of n-grams
SHARE = 4096  # a context with a larger part than 1 in this many tokens may need several buckets
FLUSH_TOKENS = 2_000_000  # tokens a task counts before it sends its blocks
ADD = 0.1  # of the unigram base score

_CELL_BITS = 4  # a directory cell of a bucket holds about 16 hashes
_BLOCK_SCHEMA = "bucket int, n long, columns binary, runs binary, counts binary, stats binary"


@dataclass
class Level:
    """What the driver knows of one order: bounded by the number of buckets."""

    buckets: int
    hot: dict[int, tuple[int, np.ndarray]]  # context: buckets it is dealt to, its totals
    discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    types: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))  # counted 1..4 times
    total: int = 0  # of the adjusted counts of words


@dataclass
class Model:
    folder: str
    order: int
    tokens: int
    vocabulary: int
    levels: dict[int, Level]


# --- n-grams of texts ------------------------------------------------------------------


def grams(texts: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Context hashes of lengths ``order - 1 .. 1``, then the word, for every token; and the
    tokens of each text. Contexts reach beyond the start of a text as BEGIN."""
    words, counts = word_hashes(texts)
    sizes = counts + 1
    ends = np.cumsum(sizes) - 1
    tokens = np.empty(int(sizes.sum()), np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = words, END
    place = np.arange(len(tokens)) - np.repeat(ends - counts, sizes)
    contexts: list[np.ndarray] = []
    for k in range(1, order):
        back = np.full(len(tokens), BEGIN, np.uint64)
        back[k:] = tokens[:-k] if k <= len(tokens) else back[k:]
        back[place < k] = BEGIN
        contexts.insert(0, combine(contexts[0], back) if contexts else mix(back))
    return [*contexts, tokens], sizes


def _local_counts(columns: list[np.ndarray], adjusted, raw):
    """Equal n-grams added up; sorted by context, then word."""
    order = np.lexsort((columns[-1], columns[0]) if len(columns) > 1 else (columns[0],))
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = columns[-1][1:] != columns[-1][:-1]
    if len(columns) > 1:
        new[1:] |= columns[0][1:] != columns[0][:-1]
    at = np.flatnonzero(new)
    add = lambda v: np.add.reduceat(v[order], at) if len(at) else v[:0]
    return [c[at] for c in columns], add(adjusted), add(raw)


def _bucket_of(columns: list[np.ndarray], level: Level) -> np.ndarray:
    """The bucket of the context; for an often used context, one of several by word."""
    base = _spread(columns[0], level.buckets)
    if level.hot and len(columns) > 1:
        keys = np.array(sorted(level.hot), np.uint64)
        parts = np.array([level.hot[int(k)][0] for k in keys], np.uint64)
        at = np.minimum(np.searchsorted(keys, columns[0]), len(keys) - 1)
        is_hot = keys[at] == columns[0]
        part = (columns[-1][is_hot] >> np.uint64(20)) % parts[at[is_hot]]
        base[is_hot] = (base[is_hot] + part.astype(np.int64)) % level.buckets
    return base


def _spread(hashes: np.ndarray, n: int) -> np.ndarray:
    """0 .. n - 1 in the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _blocks(columns, adjusted, raw, level: Level) -> Iterator[dict]:
    """One row for each bucket; contexts as runs, counts in 32 bits, or 64 where one needs them."""
    bucket = _bucket_of(columns, level)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(level.buckets + 1))
    for b in range(level.buckets):
        pick = order[bounds[b] : bounds[b + 1]]
        if not len(pick):
            continue
        own = [c[pick] for c in columns]
        if len(own) > 1:
            at = np.flatnonzero(np.append(True, own[0][1:] != own[0][:-1]))
            runs = np.diff(np.append(at, len(pick))).astype(np.uint32)
            own[:-1] = [c[at] for c in own[:-1]]
        else:
            runs = np.zeros(0, np.uint32)
        yield {
            "bucket": b,
            "n": len(pick),
            "columns": b"".join(c.tobytes() for c in own),
            "runs": runs.tobytes(),
            "counts": _narrow(np.concatenate([adjusted[pick], raw[pick]])).tobytes(),
            "stats": b"",
        }


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts as 32-bit numbers, or 64-bit ones if any is too large."""
    return counts.astype("<u4" if not len(counts) or counts.max() < 1 << 32 else "<u8")


def _read_blocks(table: pa.Table, width: int):
    parts: list[list[np.ndarray]] = []
    for n, columns, runs, counts in zip(
        table["n"].to_pylist(), table["columns"], table["runs"], table["counts"], strict=True
    ):
        if not n:
            continue
        runs = np.frombuffer(runs.as_py(), "<u4")
        flat = np.frombuffer(columns.as_py(), "<u8")
        own, at = [], 0
        for _ in range(width - 1):
            own.append(np.repeat(flat[at : at + len(runs)], runs))
            at += len(runs)
        counts = counts.as_py()
        values = np.frombuffer(counts, f"<u{len(counts) // (2 * n)}").astype(np.int64)
        parts.append([*own, flat[at:], values[:n], values[n:]])
    if not parts:
        empty = np.zeros(0, np.int64)
        return [empty.astype(np.uint64)] * width, empty, empty
    joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
    return joined[:-2], joined[-2], joined[-1]


# --- counting --------------------------------------------------------------------------


def _survey(texts: DataFrame, order: int, share: int) -> tuple[int, dict[int, dict[int, int]]]:
    """Tokens of all texts, and contexts that may have more than 1 in ``share`` of them.

    A context with so large a part of all tokens has it in some task, so the contexts that
    are large in their task, at most ``share`` in each, hold all of those sought.
    """

    def count(batches):
        total, seen = 0, {k: [] for k in range(order - 1)}
        n_seen = 0
        found: dict[tuple[int, int], int] = {}

        def flush():
            nonlocal n_seen
            for k, parts in seen.items():
                if parts:
                    keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                    for key, c in zip(keys[counts * share > n_seen], counts[counts * share > n_seen], strict=True):
                        found[k, int(key)] = found.get((k, int(key)), 0) + int(c)
                parts.clear()
            n_seen = 0

        for batch in batches:
            for piece in pieces(batch, "text"):
                columns, sizes = grams(piece.column(0), order)
                total += int(sizes.sum())
                n_seen += int(sizes.sum())
                for k in range(order - 1):
                    seen[k].append(columns[k])
                if n_seen >= FLUSH_TOKENS:
                    flush()
        flush()
        rows = [(-1, 0, total), *((k, np.uint64(h).astype(np.int64).item(), c) for (k, h), c in found.items())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)],
            names=["level", "hash", "n"],
        )

    rows = texts.mapInArrow(count, "level int, hash long, n long").groupBy("level", "hash").agg(F.sum("n").alias("n"))
    total = rows.filter("level = -1").agg(F.sum("n")).first()[0] or 0
    large = rows.filter((F.col("level") >= 0) & (F.col("n") * share > total)).collect() if total else []
    hot: dict[int, dict[int, int]] = {}
    for r in large:
        hot.setdefault(order - r.level, {})[int(np.int64(r.hash).astype(np.uint64))] = r.n
    return total, hot


def train(texts: DataFrame, order: int = ORDER, bucket_tokens: int = BUCKET_TOKENS) -> Model:
    """Count ``texts(text string)`` into a model; every row counts, null as an empty text.

    Without rows the model has no tokens and gives every word the same probability.
    """
    spark = texts.sparkSession
    folder = f"{_mounted(shared_dir(spark))}/lm-{uuid.uuid4().hex}"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens, hot = _survey(texts.select("text"), order, SHARE)
    buckets = max(least, -(-tokens // bucket_tokens))
    if buckets > SHARE:
        tokens, hot = _survey(texts.select("text"), order, buckets)
    levels = {
        m: Level(
            buckets,
            {
                context: (-(-n * buckets // tokens), np.zeros(4))
                for context, n in hot.get(m, {}).items()
                if n * buckets > tokens
            },
        )
        for m in range(1, order + 1)
    }

    def count(batches):
        held: list[list[np.ndarray]] = []
        n = 0

        def flush():
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            ones = np.ones(len(columns[0]), np.int64)
            columns, adjusted, _ = _local_counts(columns, ones, ones)
            held.clear()
            yield from _record_batches(_blocks(columns, adjusted, adjusted, levels[order]))

        for batch in batches:
            for piece in pieces(batch, "text"):
                columns, _ = grams(piece.column(0), order)
                held.append(columns)
                n += len(columns[0])
                if n >= FLUSH_TOKENS:
                    yield from flush()
                    n = 0
        if n:
            yield from flush()

    types = {m: np.zeros(4, np.int64) for m in levels}
    vocabulary = 0
    blocks = texts.select("text").mapInArrow(count, _BLOCK_SCHEMA)
    # every bucket gets its files, also one without n-grams: a file that is missing is lost
    nothing = {f.name: F.lit(0).cast(f.dataType) if f.name == "n" else F.lit(b"") for f in blocks.schema if f.name != "bucket"}
    stubs = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), *(c.alias(n) for n, c in nothing.items()))
    blocks = blocks.unionByName(stubs)
    for m in range(order, 0, -1):
        blocks = blocks.groupBy("bucket").applyInArrow(
            _reducer(folder, m, order, levels[m], levels.get(m - 1)), _BLOCK_SCHEMA
        )
    # Only totals are left: one row for each order and often used context after adding up.
    for r in _totals(blocks):
        if r.kind == 0:
            types[r.level][:] = r.a, r.b, r.c, r.d
        elif r.kind == 1:
            vocabulary, levels[1].total = r.a, r.b
        else:
            levels[r.level].hot[int(np.int64(r.hash).astype(np.uint64))][1][:] = r.a, r.b, r.c, r.d
    for m, level in levels.items():
        level.discounts = _discounts(types[m])
        level.types = types[m]
    return Model(folder, order, tokens, vocabulary, levels)


def _record_batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("bucket", pa.int32()), ("n", pa.int64())] + [(c, pa.binary()) for c in ("columns", "runs", "counts", "stats")]
    )
    for row in rows:
        yield pa.RecordBatch.from_pylist([row], schema)


def _reducer(folder: str, m: int, order: int, level: Level, below: Level | None):
    """Add up the blocks of a bucket, write its part of the model, pass on the next order.

    Files are written under a name of the attempt and renamed, so a repeated task does no
    harm. Statistics travel on in rows of their own, dealt over the buckets.
    """

    def reduce(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        columns, adjusted, raw = _read_blocks(table, m)
        columns, adjusted, raw = _local_counts(columns, adjusted, raw)
        stats = [np.frombuffer(s.as_py(), "<i8") for s in table["stats"]]
        found = [[m, 0, 0, *(int((adjusted == c).sum()) for c in (1, 2, 3, 4))]]
        if m > 1:
            context = columns[0]
            at = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else np.zeros(0, int)
            totals = np.stack(
                [np.add.reduceat(v, at) if len(at) else v[:0] for v in _context_columns(adjusted)], axis=1
            ).astype(np.float64)
            hashes = combine(context, columns[-1])
            by_hash = np.argsort(hashes)
            _save(folder, m, bucket, contexts=context[at], totals=totals, **_directory(hashes[by_hash]), counts=_narrow(adjusted[by_hash]))
            for i in np.flatnonzero(np.isin(context[at], np.array(sorted(level.hot), np.uint64))):
                found.append([m, 2, context[at][i].astype(np.int64).item(), *totals[i].astype(np.int64).tolist()])
            # each distinct n-gram counts once for the one without its first word
            rows = [*_blocks(*_local_counts(columns[1:], np.ones(len(raw), np.int64), raw), below)]
        else:
            # the base needs all tokens of a word, the model its different predecessors
            _save(folder, 1, bucket, words=columns[0], adjusted=adjusted, raw=raw)
            found.append([1, 1, 0, len(columns[0]), int(adjusted.sum()), 0, 0])
            rows = []
        stats = np.concatenate([*stats, np.array(found, "<i8").ravel()])
        rows.append({"bucket": bucket, "n": 0, "columns": b"", "runs": b"", "counts": b"", "stats": stats.tobytes()})
        return pa.Table.from_batches(_record_batches(iter(rows)))

    return reduce


def _totals(blocks: DataFrame) -> list:
    fields = ("level", "kind", "hash", "a", "b", "c", "d")

    def split(batches):
        for batch in batches:
            for stats in batch.column(0):
                rows = np.frombuffer(stats.as_py(), "<i8").reshape(-1, len(fields))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T.copy()], names=list(fields))

    rows = blocks.select("stats").mapInArrow(split, ", ".join(f"{f} long" for f in fields))
    return rows.groupBy(*fields[:3]).agg(*(F.sum(f).alias(f) for f in fields[3:])).collect()


def _context_columns(adjusted: np.ndarray) -> list[np.ndarray]:
    """What a context needs of each of its n-grams: count, seen once, twice, more often."""
    return [adjusted, *((adjusted == c).astype(np.int64) for c in (1, 2)), (adjusted >= 3).astype(np.int64)]


def _discounts(types: np.ndarray) -> np.ndarray:
    """Chen and Goodman's discounts of counts 0, 1, 2, 3 and more; fixed ones where the
    counts of counts are too few to estimate them."""
    n1, n2, n3, n4 = (int(x) for x in types[:4])
    fixed = np.array([0.0, 0.5, 1.0, 1.5])
    if not (n1 and n2 and n3 and n4):
        return fixed
    y = n1 / (n1 + 2 * n2)
    found = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return found if all(0 < d <= c for c, d in enumerate(found[1:], 1)) else fixed


# --- files -----------------------------------------------------------------------------


def _mounted(root: str) -> str:
    """The shared folder as a path; memory mapping needs it mounted on every worker."""
    if root.startswith("file:"):
        return "/" + root[5:].lstrip("/")
    if "://" in root:
        raise ValueError(f"the model is memory-mapped: {root} has to be a mounted folder")
    return root


def _save(folder: str, m: int, bucket: int, **arrays: np.ndarray) -> None:
    own = f"{folder}/{m}/{bucket % 1000:03d}"
    os.makedirs(own, exist_ok=True)
    for name, values in arrays.items():
        path = f"{own}/{bucket}-{name}.npy"
        trial = f"{path}.{uuid.uuid4().hex}"
        with open(trial, "wb") as file:
            np.save(file, values)
        os.replace(trial, path)


class _Files:
    """Arrays of a model, mapped when first used and for the life of a task."""

    def __init__(self, folder: str):
        self.folder, self.open = folder, {}

    def get(self, m: int, bucket: int, *names: str) -> list[np.ndarray] | None:
        if (m, bucket) not in self.open:
            stem = f"{self.folder}/{m}/{bucket % 1000:03d}/{bucket}-"
            if not os.path.exists(f"{stem}{names[-1]}.npy"):
                raise FileNotFoundError(f"the model has lost {stem}{names[-1]}.npy: train it again")
            arrays = [np.load(f"{stem}{n}.npy", mmap_mode="r") for n in names]
            self.open[m, bucket] = arrays if len(arrays[-1]) else None  # no n-grams
        return self.open[m, bucket]


def _directory(hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted hashes as a directory of leading bits and, in each cell, the 32 bits after."""
    bits = max(0, int(len(hashes)).bit_length() - _CELL_BITS)
    cells = np.arange((1 << bits) + 1, dtype=np.uint64)
    starts = np.searchsorted(_leading(hashes, bits), cells).astype(np.uint32)
    tails = (hashes << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
    return {"starts": starts, "tails": tails}


def _leading(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64)


def _find(starts: np.ndarray, tails: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes, -1 where absent: a binary search in all cells at once."""
    if not len(tails):
        return np.full(len(hashes), -1)
    bits = (len(starts) - 1).bit_length() - 1
    cell = _leading(hashes, bits).astype(np.int64)
    tail = (hashes << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
    low, high = starts[cell].astype(np.int64), starts[cell + 1].astype(np.int64)
    end = high.copy()
    for _ in range(int((high - low).max(initial=0)).bit_length()):
        middle = (low + high) >> 1
        less = (middle < high) & (tails[np.minimum(middle, len(tails) - 1)] < tail)
        low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
    found = (low < end) & (tails[np.minimum(low, len(tails) - 1)] == tail)
    return np.where(found, low, -1)


# --- scoring ---------------------------------------------------------------------------


def _by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(buckets.astype(np.uint32), kind="stable")
    ordered = buckets[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else []
    for at, to in zip(starts, np.append(starts[1:], len(order)) if len(order) else [], strict=True):
        yield int(ordered[at]), order[at:to]


def _gamma(totals: np.ndarray, discounts: np.ndarray) -> np.ndarray:
    """The weight of the shorter context, from count, once, twice and more often seen."""
    return (totals[..., 1:] @ discounts[1:]) / totals[..., 0]


def _probabilities(columns: list[np.ndarray], model: Model, files: _Files):
    """Probability of every token and the training count of its word."""
    words = columns[-1]
    level = model.levels[1]
    adjusted, raw = np.zeros(len(words)), np.zeros(len(words))
    for bucket, pick in _by_bucket(_spread(words, level.buckets)):
        arrays = files.get(1, bucket, "words", "adjusted", "raw")
        if arrays is None or not len(arrays[0]):
            continue
        at = np.minimum(np.searchsorted(arrays[0], words[pick]), len(arrays[0]) - 1)
        hit = arrays[0][at] == words[pick]
        adjusted[pick], raw[pick] = np.where(hit, arrays[1][at], 0), np.where(hit, arrays[2][at], 0)
    if level.total:
        n = np.array([level.total, *level.types[:2], model.vocabulary - level.types[0] - level.types[1]], float)
        p = (adjusted - level.discounts[np.minimum(adjusted, 3).astype(int)]) / level.total
        p += _gamma(n, level.discounts) / (model.vocabulary + 1)
    else:
        p = np.full(len(words), 1.0 / (model.vocabulary + 1))
    for m in range(2, model.order + 1):
        level = model.levels[m]
        own = columns[model.order - m :]
        context, hashes = own[0], combine(own[0], words)
        share, gamma = np.zeros(len(words)), np.ones(len(words))
        for bucket, pick in _by_bucket(_bucket_of(own, level)):
            arrays = files.get(m, bucket, "contexts", "totals", "starts", "tails", "counts")
            if arrays is None or not len(arrays[0]):
                continue
            contexts, totals, starts, tails, counts = arrays
            at = np.minimum(np.searchsorted(contexts, context[pick]), len(contexts) - 1)
            known = contexts[at] == context[pick]
            pick, at = pick[known], at[known]
            place = _find(starts, tails, hashes[pick])
            count = np.where(place >= 0, counts[np.maximum(place, 0)], 0).astype(np.float64)
            share[pick] = count - level.discounts[np.minimum(count, 3).astype(int)]
            share[pick] /= totals[at, 0]
            gamma[pick] = _gamma(np.asarray(totals[at]), level.discounts)
        for key, (_, totals) in level.hot.items():  # totals of the parts, added up
            if totals[0]:
                pick = np.flatnonzero(context == np.uint64(key))
                gamma[pick] = _gamma(totals, level.discounts)
                share[pick] = _hot_shares(own, pick, hashes, level, m, files) / totals[0]
        p = share + gamma * p
    return p, raw


def _hot_shares(own, pick, hashes, level: Level, m: int, files: _Files) -> np.ndarray:
    values = np.zeros(len(pick))
    for bucket, part in _by_bucket(_bucket_of([c[pick] for c in own], level)):
        arrays = files.get(m, bucket, "contexts", "totals", "starts", "tails", "counts")
        if arrays is not None:
            place = _find(arrays[2], arrays[3], hashes[pick[part]])
            count = np.where(place >= 0, arrays[4][np.maximum(place, 0)] if len(arrays[4]) else 0, 0).astype(float)
            values[part] = count - level.discounts[np.minimum(count, 3).astype(int)]
    return values


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, *keep, n_tokens, n_known, base_score, score`` of every row of ``docs``.

    Scores are sums of log10 probabilities over the words and one end. A null or blank text
    is the end alone; repeated rows give repeated rows.
    """
    base_total = model.tokens + ADD * (model.vocabulary + 1)
    passed = [id_column, *keep]
    schema = extended(docs.select(*passed), n_tokens="long", n_known="long", base_score="double", score="double")

    def work(batches):
        files = _Files(model.folder)
        for batch in batches:
            for piece in pieces(batch, "text"):
                columns, sizes = grams(piece.column(len(passed)), model.order)
                p, raw = _probabilities(columns, model, files)
                outputs = [
                    sizes,
                    row_sums(raw > 0, sizes).astype(np.int64),
                    row_sums(np.log10((raw + ADD) / base_total), sizes),
                    row_sums(np.log10(p), sizes),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns[: len(passed)], *map(pa.array, outputs)], names=schema.names
                )

    return docs.select(*passed, "text").mapInArrow(work, schema)
