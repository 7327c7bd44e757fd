"""Fill-in-the-middle: texts cut at two token boundaries and put together with sentinels.

The ends of all tokens of a block of texts, which stand one after the other, are one compressed set
of byte places (:mod:`chanlake.llm.boundaries`). A text's tokens are a range of its ranks, so that
a cut after ``k`` units is the place of one rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.llm.boundaries import BoundarySet
from chanlake.llm.columns import carried, restored
from chanlake.llm.ship import extended, ship
from chanlake.llm.words import pieces, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINELS = tuple(s.encode() for s in (PREFIX, SUFFIX, MIDDLE))
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
ADDED = {"n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output": "string"}


@dataclass(frozen=True)
class Recipe:
    """``rate``: of 100 texts, those that are cut; ``suffix_first``: of 100 of these, those with the
    suffix before the prefix. ``units``: ``words`` (a word with the blanks before it) or
    ``characters``. ``seed`` stands before the id in the digest that decides."""

    rate: int = 50
    suffix_first: int = 80
    seed: int = 42
    units: str = "words"

    def __post_init__(self):
        if not (0 <= self.rate <= 100 and 0 <= self.suffix_first <= 100):
            raise ValueError("rate and suffix_first go from 0 to 100")
        if self.units not in ("words", "characters"):
            raise ValueError("units are words or characters")


def draws(row_id: Column, seed: int) -> Column:
    """Four numbers from 0 to 4294967295: the first 32 hex digits of the SHA-256 digest of the
    seed, a colon and the id. A null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)))


def unit_ends(data: np.ndarray, offsets: np.ndarray, units: str) -> np.ndarray:
    """Where the units of all texts end, ascending.

    Words: a run of other bytes than blank, tab, line feed, vertical tab, form feed and carriage
    return, with such bytes before it, or such bytes up to the end of the text. Characters: code
    points.
    """
    ends = np.zeros(len(data) + 1, bool)
    if units == "words":
        space = _SPACE[data]
        ends[1:-1] = ~space[:-1] & space[1:]
    else:
        ends[1:-1] = (data[1:] & 0xC0) != 0x80
    ends[offsets[1:][np.diff(offsets) > 0]] = True
    ends[0] = False
    return np.flatnonzero(ends)


def _arrange(recipe: Recipe):
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column("text"))
        draw = batch.column("_draws").flatten().to_numpy(zero_copy_only=False).astype(np.uint64).reshape(-1, 4)
        ends = unit_ends(data, offsets, recipe.units)
        first = np.searchsorted(ends, offsets[:-1], "right")
        n = np.searchsorted(ends, offsets[1:], "right") - first
        known = BoundarySet(ends)
        chosen = draw[:, :2] % (n + 1).astype(np.uint64)[:, None]
        cuts = np.sort(chosen.astype(np.int64), axis=1)
        inside = cuts > 0  # a cut after no unit is the start of the text
        place = np.repeat(offsets[:-1, None], 2, 1)
        place[inside] = known.select((first[:, None] + cuts - 1)[inside])
        heads = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # characters before each byte
        prefix_chars = heads[place[:, 0]] - heads[offsets[:-1]]
        middle_chars = heads[place[:, 1]] - heads[place[:, 0]]
        asked = (draw[:, 2] % np.uint64(100) < recipe.rate) & (np.diff(offsets) > 0)
        spm = draw[:, 3] % np.uint64(100) < recipe.suffix_first
        whole, form, out = memoryview(data), [], []
        for row in range(batch.num_rows):
            low, high = int(offsets[row]), int(offsets[row + 1])
            text = bytes(whole[low:high])
            if not asked[row] or any(s in text for s in _SENTINELS):
                form.append("plain")
                out.append(text)
                continue
            a, b = int(place[row, 0]) - low, int(place[row, 1]) - low
            prefix, suffix, middle = (_SENTINELS[0], text[:a]), (_SENTINELS[1], text[b:]), (_SENTINELS[2], text[a:b])
            order = (suffix, prefix, middle) if spm[row] else (prefix, suffix, middle)
            form.append("spm" if spm[row] else "psm")
            out.append(b"".join(part for pair in order for part in pair))
        form = pa.array(form, pa.string())
        cut = np.array([f != "plain" for f in form.to_pylist()], bool)
        counted = [pa.array(v, pa.int64(), mask=~cut) for v in (prefix_chars, middle_chars)]
        names = [name for name in batch.schema.names if name != "_draws"]
        added = [pa.array(n, pa.int64()), form, *counted, pa.array(out, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *added], [*names, *ADDED])

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield of(part)

    return arrange


def fill_in_middle(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """Every row of ``docs`` with ``n, form, prefix_chars, middle_chars, output``.

    ``n``: units of the text; a null text is empty. The four draws of the row's ``doc_id`` say after
    how many units the prefix and the middle end (the smaller and the larger of the first two,
    modulo ``n + 1``), whether the text is cut, and which part comes first. ``form`` is ``plain``,
    with the text as output and null counts, where it is not cut, is empty, or contains a sentinel;
    ``psm``: prefix, suffix, middle, each behind its sentinel; ``spm``: suffix, prefix, middle.
    Equal rows give equal results; a null id draws as an empty one. Existing columns of the names
    added are replaced. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    docs = docs.drop(*ADDED)
    needed = ("doc_id", "text")
    rows = carried(docs, *needed)
    schema = extended(rows, **ADDED)
    drawn = rows.withColumn("_draws", draws(F.col("doc_id"), recipe.seed))
    return restored(drawn.mapInArrow(_arrange(recipe), schema), docs, *needed, added=tuple(ADDED))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""

    def between(start: str, end: str | None) -> Column:
        rest = F.substr(output, F.locate(start, output) + F.lit(len(start)))
        return rest if end is None else F.substring_index(rest, end, 1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
