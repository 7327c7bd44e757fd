"""Words of whole text columns as 64-bit hashes, a column at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20  # bytes hashed at once; longer texts take several blocks


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix64 generator: a bijection that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash for an ordered pair of hashes."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


_BYTE = np.arange(256, dtype=np.uint64)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_VALUE = mix(_LOWER.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
_FACTOR = 0xD1342543DE82EF95


def _powers(factor: int) -> np.ndarray:
    values = np.full(_BLOCK + 1, factor, np.uint64)
    values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


_POWER, _INVERSE = _powers(_FACTOR), _powers(pow(_FACTOR, -1, 1 << 64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all rows in order, and the number of words of each row.

    A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
    carriage return; A-Z count as a-z. Null and blank texts have no words.
    """
    data, offsets = text_bytes(texts)
    space = _SPACE[data]
    bounds = np.zeros(len(data) + 1, bool)
    bounds[offsets] = True
    first, last = bounds[:-1].copy(), bounds[1:].copy()
    first[1:] |= space[:-1]
    last[:-1] |= space[1:]
    starts, ends = np.flatnonzero(first & ~space), np.flatnonzero(last & ~space) + 1
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, "right")))
        low, high = starts[at], ends[to - 1]
        if high - low > _BLOCK:  # one word longer than a block
            hashes[at] = _long_word(data[low:high])
        else:
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_VALUE[data[low:high]] * _POWER[: high - low], out=sums[1:])
            begin = starts[at:to] - low
            own = (sums[ends[at:to] - low] - sums[begin]) * _INVERSE[begin]
            hashes[at:to] = mix(own + (ends[at:to] - starts[at:to]).astype(np.uint64))
        at = to
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def _long_word(data: np.ndarray) -> np.uint64:
    total = np.zeros(1, np.uint64)
    for at in range(0, len(data), _BLOCK):
        piece = data[at : at + _BLOCK]
        own = (_VALUE[piece] * _POWER[: len(piece)]).sum(dtype=np.uint64)
        total = combine(total, np.array([own], np.uint64))
    return total[0]


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``max_bytes`` of text each, so memory stays bounded."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def row_of(counts: np.ndarray) -> np.ndarray:
    """The row each item belongs to, given the number of items of each row."""
    return np.repeat(np.arange(len(counts)), counts)


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over the items of each row; 0 for a row without items."""
    return np.bincount(row_of(counts), weights=values, minlength=len(counts))


def groups(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of equal neighbours (rows, if there are columns) begin and end."""
    new = np.ones(len(labels), bool)
    changed = labels[1:] != labels[:-1]
    new[1:] = changed.any(1) if changed.ndim > 1 else changed
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(labels))[: len(first)]
