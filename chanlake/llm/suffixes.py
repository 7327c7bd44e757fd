"""Exact duplicates of substrings, by a radix sort of suffixes that goes no deeper than a threshold.

Two texts share a substring of at least ``length`` bytes exactly if two of their suffixes agree
in the first ``length`` bytes, so suffixes are ordered by these bytes only. The digits are taken
from the most significant on, and after each pass the suffixes that are alone in their group, or
share it with none of another document, are done:

1. The first digit of a suffix is the 16 byte string with the least hash among those that lie
   in its first ``length`` bytes (the leftmost of equal ones). It depends on these bytes alone,
   so equal suffixes agree in it, and neighbouring suffixes mostly have it in common: a run of
   them goes through the shuffle as one stretch of text, dealt by this digit.
2. In a task's bucket, runs are ordered by the bytes of the first digit, in two passes of 8.
3. The runs that are left become suffixes, which are ordered by the place of the first digit and
   then by seven digits of 8 bytes; the last overlaps the one before.

The groups of equal suffixes that remain are exactly the repeated windows. A bucket sends the spans
they cover to parts of the documents, a block for each part: a row for each document and bucket would
be many more, as a document has runs in the more buckets the more there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm.columns import carried, restored
from chanlake.llm.ship import extended, ship
from chanlake.llm.words import groups, mix, text_bytes
from chanlake.session import materialised

LENGTH = 50  # bytes of a window
GRAM = 16  # bytes of the first digit
WIDEST = 2 * LENGTH - GRAM  # bytes of the longest run
BLOCK = 1 << 20  # bytes of text ordered into runs at once; longer texts take several blocks
FLUSH = 1 << 23  # bytes of text whose runs leave a task together
BUCKET_BYTES = 4 << 20  # mean bytes of text of a bucket
PARTS, PART_BYTES = 64, 256 << 20  # least parts that spans are dealt to, and mean bytes of text of a part
LAST_ID = np.iinfo(np.int64).max  # a null id comes after all others
_CODEC = pa.Codec("zstd", 3)


@dataclass
class Runs:
    """Runs of neighbouring windows with one first digit, each with its stretch of text."""

    content: np.ndarray  # the stretches, one after the other
    lengths: np.ndarray  # bytes of each
    gram: np.ndarray  # place of the first digit in it
    start: np.ndarray  # place of it in its document
    doc: np.ndarray  # row of its document in the table of documents
    ids: np.ndarray  # the table: id
    keys: np.ndarray  # and key of the text

    def packed(self) -> bytes:
        """One compressed block of bytes."""
        # places as steps within a document compress better
        new = np.ones(len(self.doc), bool)
        new[1:] = self.doc[1:] != self.doc[:-1]
        step = np.diff(self.start, prepend=0)
        step[new] = self.start[new]
        counts = np.diff(np.append(np.flatnonzero(new), len(new)))
        used = self.doc[new]
        order = np.argsort(self.ids[used], kind="stable")  # documents by id: small steps
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids = self.ids[used][order]
        parts = [
            self.lengths.astype(np.uint8), self.gram.astype(np.uint8), step.astype(np.uint32), counts.astype(np.uint32),
            (rank - np.arange(len(rank))).astype(np.int32), np.diff(ids.view(np.uint64), prepend=np.uint64(0)), self.keys[used][order],
        ]
        # the first bytes of all numbers, then the second ones: high bytes are mostly zeros
        planes = [np.ascontiguousarray(p.view(np.uint8).reshape(len(p), -1).T).tobytes() for p in parts]
        raw = b"".join([np.array([len(self.doc), len(used)], np.int64).tobytes(), *planes, self.content.tobytes()])
        return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)

    @classmethod
    def unpacked(cls, block: bytes) -> Runs:
        raw = np.frombuffer(_CODEC.decompress(memoryview(block)[8:], int.from_bytes(block[:8], "little")), np.uint8)
        runs, docs = (int(n) for n in raw[:16].view(np.int64))
        at = 16

        def take(kind, count: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize
            planes = raw[at : at + size * count].reshape(size, count)
            at += size * count
            return np.ascontiguousarray(planes.T).view(kind).reshape(count)

        lengths, gram, step = take(np.uint8, runs), take(np.uint8, runs), take(np.uint32, runs)
        counts, rank = take(np.uint32, docs), take(np.int32, docs) + np.arange(docs)
        ids, keys = np.cumsum(take(np.uint64, docs), dtype=np.uint64).view(np.int64), take(np.int64, docs)
        first = np.cumsum(counts, dtype=np.int64) - counts
        total = np.cumsum(step, dtype=np.int64)
        base = np.repeat(total[first] - step[first], counts) if docs else np.zeros(0, np.int64)
        return cls(raw[at:], lengths.astype(np.int64), gram.astype(np.int64), total - base, np.repeat(rank, counts), ids, keys)


def digits(content: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number that orders as the bytes do; ``content`` goes
    on for 8 bytes after the last place."""
    return np.ndarray((max(len(content) - 7, 0),), ">u8", content, 0, (1,))[at].astype(np.uint64)


def _first_digits(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window its first digit's place, and for each place the digit's hash."""
    width = LENGTH - GRAM + 1
    count = len(data) - GRAM + 1
    low = np.ndarray((count,), "<u8", data, 0, (1,)).astype(np.uint64)
    low *= np.uint64(0x9E3779B97F4A7C15)
    low ^= low >> np.uint64(29)
    low += np.ndarray((count,), "<u8", data, 8, (1,))
    low *= np.uint64(0xBF58476D1CE4E5B9)
    low ^= low >> np.uint64(32)
    low *= np.uint64(0x94D049BB133111EB)
    least = low & np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(count, dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    return least.astype(np.uint32), low  # the lower half is the place


@dataclass
class Found:
    """Runs that still lie in the block of text they were found in."""

    data: np.ndarray
    begin: np.ndarray  # of each run in the block
    lengths: np.ndarray
    gram: np.ndarray
    start: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray  # of each run's first digit
    ids: np.ndarray
    keys: np.ndarray

    @classmethod
    def joined(cls, parts: list[Found]) -> Found:
        data = np.cumsum([0, *(len(p.data) for p in parts)])
        docs = np.cumsum([0, *(len(p.ids) for p in parts)])
        own = {f: np.concatenate([getattr(p, f) for p in parts]) for f in cls.__dataclass_fields__}
        own["begin"] = np.concatenate([p.begin + n for p, n in zip(parts, data, strict=False)])
        own["doc"] = np.concatenate([p.doc + n for p, n in zip(parts, docs, strict=False)])
        own["data"] = np.append(own["data"], np.zeros(WIDEST, np.uint8))  # so that any run can be read at full width
        return cls(**own)

    def taken(self, chosen: np.ndarray) -> Runs:
        """Runs with these numbers, with their stretches; of blocks that were joined."""
        lengths = self.lengths[chosen]
        wide = np.ndarray((len(self.data) - WIDEST + 1,), f"V{WIDEST}", self.data, 0, (1,))
        stretches = wide[self.begin[chosen]].view(np.uint8).reshape(-1, WIDEST)
        content = stretches[np.arange(WIDEST, dtype=np.uint8) < lengths.astype(np.uint8)[:, None]]
        return Runs(content, lengths, self.gram[chosen], self.start[chosen], self.doc[chosen], self.ids, self.keys)

    def known_here(self) -> np.ndarray:
        """Runs whose whole stretch also stands in a document with a smaller id among these."""
        ids = self.ids[self.doc]
        known = np.zeros(len(ids), bool)
        if not len(ids):
            return known
        ends = self.begin + self.lengths - 8
        shape = (self.lengths * 256 + self.gram).astype(np.uint64)
        tag = mix(self.hashes + digits(self.data, self.begin))
        tag = mix(tag + digits(self.data, ends) * np.uint64(3) + shape)
        order = np.argsort(tag, kind="stable")
        first, last = groups(tag[order])
        several = np.repeat(last - first > 1, last - first)  # only these have to be ordered by id
        where = np.flatnonzero(several)
        order[where] = order[where][np.lexsort((ids[order[where]], tag[order[where]]))]
        head = np.repeat(order[first], last - first)
        copies = ids[order] > ids[head]
        copy, of = order[copies], head[copies]
        same = self.lengths[copy] == self.lengths[of]  # equal tags are a hint; the bytes decide
        for place in range(0, WIDEST, 8):
            mine, other = (np.minimum(self.begin[r] + place, ends[r]) for r in (copy, of))
            same &= digits(self.data, mine) == digits(self.data, other)
        known[copy[same]] = True
        return known


def runs_of(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, origin: np.ndarray, ids, keys) -> Found:
    """Runs of texts that lie one after the other.

    ``doc`` and ``origin``: the row of the table of each text, and where in it the text begins.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return Found(data, none, none, none, none, none, none.astype(np.uint64), ids, keys)
    place, hashes = _first_digits(data)
    change = np.ones(len(place) + 1, bool)
    np.not_equal(place[1:], place[:-1], out=change[1:-1])
    for bounds in (offsets, offsets - (LENGTH - 1)):  # where a text and where its windows end
        change[bounds[(bounds > 0) & (bounds < len(place))]] = True
    bounds = np.flatnonzero(change)
    begin, count = bounds[:-1], np.diff(bounds)
    own = np.searchsorted(offsets, begin, "right") - 1
    valid = begin + LENGTH <= offsets[own + 1]
    begin, count, own = begin[valid], count[valid], own[valid]
    grams = place[begin].astype(np.int64)
    return Found(
        data, begin, count + (LENGTH - 1), grams - begin, begin - offsets[own] + origin[own], doc[own], hashes[grams], ids, keys
    )


def _spans(starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each document the union of its stretches as disjoint spans in order; touching ones are one."""
    if not len(doc):
        return
    order = np.lexsort((starts, doc))
    starts, ends, doc = starts[order], ends[order], doc[order]
    wide = int(ends.max()) + 2  # documents side by side, with a gap
    base = (np.cumsum(np.append(False, doc[1:] != doc[:-1]))) * wide
    reach = np.maximum.accumulate(ends + base)
    new = np.ones(len(doc), bool)
    new[1:] = starts[1:] + base[1:] > reach[:-1]
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(doc)) - 1
    first, to, own = starts[head], reach[last] - base[head], doc[head]
    for low, high in zip(*groups(own), strict=True):
        yield int(own[low]), first[low:high], to[low:high]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *(len(v) for v in values)])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32)))


_FOUND = pa.schema([("_id", pa.int64()), ("_key", pa.int64()), ("_from", pa.list_(pa.int32())), ("_to", pa.list_(pa.int32()))])
_SENT = pa.schema([("bucket", pa.int32()), ("runs", pa.binary()), *_FOUND])


_DEALT = pa.schema([("part", pa.int32()), ("spans", pa.binary())])


def _found_columns(rows: list[tuple], ids: np.ndarray, keys: np.ndarray) -> list[pa.Array]:
    docs = np.array([doc for doc, _, _ in rows], np.int64)
    spans = [_lists([row[k] for row in rows]) for k in (1, 2)]
    return [pa.array(ids[docs]), pa.array(keys[docs]), *spans]


def _sender(buckets: int, rounds: int, turn: int):
    """Texts to runs, dealt to buckets by the first digit, and to what is known without them."""

    def flush(held: list[Found]) -> Iterator[pa.RecordBatch]:
        runs = Found.joined(held)
        deal = mix(runs.hashes ^ np.uint64(0x632BE59BD9B4E019)) % np.uint64(buckets * rounds)
        here = deal // np.uint64(buckets) == turn
        bucket = (deal % np.uint64(buckets)).astype(np.int32)
        known = runs.known_here() & here
        rows = list(_spans(runs.start[known], runs.start[known] + runs.lengths[known], runs.doc[known]))
        if rows:
            done = _found_columns(rows, runs.ids, runs.keys)
            key = mix(done[0].to_numpy().view(np.uint64) + mix(done[1].to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((key % np.uint64(buckets)).astype(np.int32)), pa.nulls(len(rows), pa.binary()), *done], schema=_SENT
            )
        order = np.flatnonzero(here & ~known)
        order = order[np.argsort(bucket[order], kind="stable")]
        for low, high in zip(*groups(bucket[order]), strict=True):
            block = pa.array([runs.taken(order[low:high]).packed()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([bucket[order[low]]], pa.int32()), block, *(pa.nulls(1, f.type) for f in _FOUND)], schema=_SENT)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids = batch.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)
            keys = batch.column("_key").to_numpy(zero_copy_only=False).astype(np.int64)
            for low, high, doc, origin in _blocks(offsets):
                bounds = np.minimum(offsets[doc[0] : doc[-1] + 2], high)
                bounds = np.maximum(bounds, low) - low
                local = doc - doc[0]
                held.append(runs_of(data[low:high], bounds, local, origin, ids[doc], keys[doc]))
                size += int(high - low)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return send


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Stretches of about ``BLOCK`` bytes: whole texts, or a piece of one that holds the windows of
    ``BLOCK`` places. Gives its bounds, its texts, and where in their text they begin."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
        low, high = int(offsets[at]), int(offsets[to])
        if to == at + 1 and high - low > BLOCK:
            for piece in range(low, high - LENGTH + 1, BLOCK):
                yield piece, min(piece + BLOCK + LENGTH - 1, high), np.array([at]), np.array([piece - low])
        else:
            yield low, high, np.arange(at, to), np.zeros(to - at, np.int64)
        at = to


def _differ(values: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Members of groups, which lie side by side, whose values are not all equal."""
    if not len(label):
        return np.zeros(0, bool)
    first, last = groups(label)
    return np.repeat(np.minimum.reduceat(values, first) != np.maximum.reduceat(values, first), last - first)


def _pass(items: np.ndarray, label: np.ndarray, digit: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass of the sort: members of each group are ordered by a digit and the group is split where
    it changes. Gives the items that are left, those with another id beside them, and their groups."""
    if not len(items):
        return items, label
    where = np.flatnonzero(_differ(digit, label))
    order = np.arange(len(items))
    order[where] = where[np.lexsort((digit[where], label[where]))]
    items, label, digit, ids = items[order], label[order], digit[order], ids[order]
    label = np.cumsum(np.append(False, (label[1:] != label[:-1]) | (digit[1:] != digit[:-1])))
    left = _differ(ids, label)
    return items[left], label[left]


def repeated(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """All windows of ``runs`` that also stand in a document with a smaller id: the row of the
    document and the place in it."""
    content = np.append(runs.content, np.zeros(8, np.uint8))
    ids = runs.ids[runs.doc]
    first = np.cumsum(runs.lengths, dtype=np.int64) - runs.lengths
    items, label = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    for place in range(0, GRAM, 8):
        items, label = _pass(items, label, digits(content, (first + runs.gram)[items] + place), ids[items])
    counts = runs.lengths[items].astype(np.int64) - (LENGTH - 1)
    run = np.repeat(items, counts)
    inside = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = runs.gram[run].astype(np.int64) - inside  # of the first digit in the window
    label = np.repeat(label, counts) * LENGTH + place
    order = np.argsort(label, kind="stable")
    run, inside, label = run[order], inside[order], label[order]
    at, own = first[run] + inside, ids[run]
    windows = np.flatnonzero(_differ(own, label))
    label = label[windows]
    for place in (*range(0, LENGTH - 7, 8), *([LENGTH - 8] if LENGTH % 8 else [])):
        windows, label = _pass(windows, label, digits(content, at[windows] + place), own[windows])
    if not len(windows):
        return windows, windows
    head, last = groups(label)
    least = np.repeat(np.minimum.reduceat(own[windows], head), last - head)
    later = windows[own[windows] > least]
    return runs.doc[run[later]], runs.start[run[later]] + inside[later]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _dealt(found: pa.Table, parts: int) -> pa.Table:
    """Spans of documents as a block for each part that they are dealt to by document."""
    found = found.combine_chunks()
    ids, keys = (found.column(c).to_numpy().astype(np.int64) for c in ("_id", "_key"))
    counts = pc.list_value_length(found.column("_from")).to_numpy().astype(np.int64)
    low, high = (pc.list_flatten(found.column(c)).to_numpy().astype(np.int32) for c in ("_from", "_to"))
    starts = np.cumsum(counts) - counts
    part = (mix(ids.view(np.uint64) + mix(keys.view(np.uint64))) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    numbers, blocks = [], []
    for first, last in zip(*groups(part[order]), strict=True) if len(order) else ():
        own = order[first:last]
        spans = _ranges(starts[own], counts[own])
        arrays = [np.array([len(own), len(spans)]), ids[own], keys[own], counts[own], low[spans], high[spans]]
        raw = b"".join(a.tobytes() for a in arrays)
        numbers.append(part[own[0]])
        blocks.append(len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True))
    return pa.Table.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], schema=_DEALT)


def _gathered(table: pa.Table) -> pa.Table:
    """The spans of each document of a part, from the blocks of all buckets."""
    held = []
    for block in (block.as_buffer() for chunk in table.column("spans").chunks for block in chunk):
        raw = np.frombuffer(_CODEC.decompress(memoryview(block)[8:], int.from_bytes(block[:8], "little")), np.uint8)
        docs, spans = (int(n) for n in raw[:16].view(np.int64))
        bounds = np.cumsum([16, 8 * docs, 8 * docs, 8 * docs, 4 * spans, 4 * spans])
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int32)
        held.append([raw[a:b].view(kind) for a, b, kind in zip(bounds, bounds[1:], kinds, strict=False)])
    ids, keys, counts, low, high = (np.concatenate(arrays) for arrays in zip(*held, strict=True))
    starts = np.cumsum(counts) - counts
    order = np.lexsort((keys, ids))
    ids, keys, spans, counts = ids[order], keys[order], _ranges(starts[order], counts[order]), counts[order]
    first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])))
    offsets = pa.array(np.append((np.cumsum(counts) - counts)[first], len(spans)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v[spans])) for v in (low, high)]
    return pa.Table.from_arrays([pa.array(ids[first]), pa.array(keys[first]), *lists], schema=_FOUND)


def _receiver(parts: int):
    """Buckets to blocks of spans for each part."""
    return lambda table: _dealt(_receive(table), parts)


def _receive(table: pa.Table) -> pa.Table:
    """All runs of a bucket to the spans of its repeated windows; spans known before pass through."""
    blocks = [block for chunk in table.column("runs").chunks for block in chunk]
    parts = [Runs.unpacked(block.as_buffer()) for block in blocks if block.is_valid]
    known = table.filter(pc.is_null(table.column("runs"))).select(_FOUND.names).cast(_FOUND)
    if not parts:
        return known
    docs = np.cumsum([0, *(len(r.ids) for r in parts)])
    runs = Runs(
        *(np.concatenate([getattr(r, f) for r in parts]) for f in ("content", "lengths", "gram", "start")),
        np.concatenate([r.doc + n for r, n in zip(parts, docs, strict=False)]),
        *(np.concatenate([getattr(r, f) for r in parts]) for f in ("ids", "keys")),
    )
    doc, start = repeated(runs)
    rows = list(_spans(start, start + LENGTH, doc))
    return pa.concat_tables([known, pa.Table.from_arrays(_found_columns(rows, runs.ids, runs.keys), schema=_FOUND)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans."""
    none = np.zeros(0, np.int64)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        data, kept, lows, highs = memoryview(data), [], [], []
        for row, (low, high) in enumerate(zip(batch.column("_from"), batch.column("_to"), strict=True)):
            low, high = (np.asarray(v.values, np.int64) if v.is_valid else none for v in (low, high))
            _, low, high = next(_spans(low, high, np.zeros(len(low), np.int64)), (0, none, none))
            lows.append(low)
            highs.append(high)
            cuts = np.stack([np.append(0, high), np.append(low, offsets[row + 1] - offsets[row])], 1) + offsets[row]
            kept.append(b"".join(data[a:b] for a, b in cuts.tolist()))
        low, high = _lists(lows), _lists(highs)
        spans = pa.StructArray.from_arrays([low.values, high.values], ["start", "end"])
        names = [name for name in batch.schema.names if name not in ("_from", "_to")]
        found = [pa.array(kept, pa.binary()), pa.ListArray.from_arrays(low.offsets, spans)]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *found], [*names, "kept", "spans"])


def remove_repeats(docs: DataFrame, rounds: int = 1) -> DataFrame:
    """Every row of ``docs`` with ``kept``, the bytes of its text that are left, and ``spans``, the
    stretches (start, end) of bytes removed from it, in order and apart.

    A byte goes if a window of 50 bytes over it also starts in a document with a smaller
    ``doc_id``. Windows are those of the whole texts as UTF-8, within one document. A null text is
    empty, and a text of fewer than 50 bytes is left as it is. A null id comes after all others;
    rows with equal ids, or without, take nothing from each other, so rows that are equal throughout
    are treated alike. Existing columns ``kept`` and ``spans`` are replaced.

    The runs of the texts are dealt to buckets of about 4 MB of text and their copies, in ``rounds``
    that follow each other, so that disk is needed for the runs of one round only. A run that a task
    has already seen whole in a document with a smaller id is not dealt.
    """
    ship(docs.sparkSession)
    docs = docs.drop("kept", "spans")
    needed = ("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(LAST_ID)))
    keyed = carried(docs, *needed).withColumns({"_id": order, "_key": F.xxhash64(text, F.octet_length(text))})
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, int(size) // BUCKET_BYTES // rounds)
    parts = max(PARTS, int(size) // PART_BYTES)
    found = []
    for turn in range(rounds):
        sent = keyed.select("_id", "_key", "text").mapInArrow(_sender(buckets, rounds, turn), _ddl(_SENT))
        found.append(materialised(sent.groupBy("bucket").applyInArrow(_receiver(parts), _ddl(_DEALT)), "repeats"))
    spans = reduce(DataFrame.unionAll, found).groupBy("part").applyInArrow(_gathered, _ddl(_FOUND))
    rows = keyed.join(spans.hint("merge"), ["_id", "_key"], "left").drop("_id", "_key")
    cut = rows.mapInArrow(_cut, extended(rows.drop("_from", "_to"), kept="binary", spans="array<struct<start: int, end: int>>"))
    return restored(cut, docs, *needed, added=("kept", "spans"))


def _ddl(schema: pa.Schema) -> str:
    kinds = {"int64": "bigint", "int32": "int", "binary": "binary"}
    return ", ".join(f"{f.name} {kinds.get(str(f.type), 'array<int>')}" for f in schema)
