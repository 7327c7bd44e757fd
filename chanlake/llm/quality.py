"""Quality selection by importance resampling.

Two generative models of hashed word unigrams and bigrams, of the target text and of all
raw text, give every document an importance weight: the ratio of its probabilities. Adding
Gumbel noise to the log weights and keeping the k highest draws k documents without
replacement, each draw in proportion to the weights of what is left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm.ship import extended
from chanlake.llm.words import combine, pieces, row_sums, word_hashes
from chanlake.session import materialised

BUCKETS = 1 << 16
SMOOTHING = 1.0  # added to every bucket's count
FRACTION = 0.8  # of the rows that are drawn
TEMPERATURE = 1.0  # of the noise


@dataclass
class Ratio:
    """Log ratio of the target's and the raw model's probability of each bucket."""

    log_ratio: np.ndarray


def _features(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs of neighbours in each text, and their numbers."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    pair = np.ones(len(words), bool)
    pair[ends[counts > 0] - 1] = False
    first = np.flatnonzero(pair)
    pairs = combine(words[first], words[first + 1]) if len(first) else words[:0]
    row = np.repeat(np.arange(len(counts)), counts)
    rows = np.concatenate([row, row[first]])
    order = np.argsort(rows, kind="stable")
    both = np.concatenate([words, pairs])[order] % np.uint64(buckets)
    return both.astype(np.int64), np.bincount(rows, minlength=len(counts))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> Ratio:
    """Count both models over all rows of ``doc_id, text``.

    Target: documents with a row ``quality = 1`` in ``labels(doc_id, quality)`` and none
    with another value; raw: all documents. Counts are added up by Spark; what reaches the
    driver has one row for each bucket. No target at all gives ratios of 0.
    """
    good = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    # labels grow with the corpus: they are never broadcast, whatever their size here
    marked = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left").select(
        "text", F.coalesce(F.col("_q") == 1, F.lit(False)).alias("target")
    )

    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                own, sizes = _features(piece.column(0), buckets)
                raw += np.bincount(own, minlength=buckets)
                wanted = np.repeat(np.asarray(piece.column(1)), sizes)
                target += np.bincount(own[wanted], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"]
        )

    counted = (
        marked.mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    raw, target = np.full(buckets, SMOOTHING), np.full(buckets, SMOOTHING)
    for r in counted:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if target.sum() <= SMOOTHING * buckets:
        return Ratio(np.zeros(buckets))
    return Ratio(np.log(target / target.sum()) - np.log(raw / raw.sum()))


def weigh(docs: DataFrame, ratio: Ratio) -> DataFrame:
    """Every row with ``n_features`` and ``log_weight``; null and blank texts have 0 and 0."""
    docs = docs.drop("n_features", "log_weight")
    schema = extended(docs, n_features="long", log_weight="double")
    text_at = docs.columns.index("text")
    log_ratio = ratio.log_ratio

    def work(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                own, sizes = _features(piece.column(text_at), len(log_ratio))
                weights = row_sums(log_ratio[own], sizes)
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(sizes.astype(np.int64)), pa.array(weights)], names=schema.names
                )

    return docs.mapInArrow(work, schema)


def gumbel(seed: int, *columns: str):
    """Standard Gumbel noise that depends on the row alone, so that reruns agree."""
    draw = (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(draw))


def resample(
    docs: DataFrame, ratio: Ratio, fraction: float = FRACTION, temperature: float = TEMPERATURE, seed: int = 1
) -> DataFrame:
    """``doc_id, n_features, log_weight, key, sampled`` of every row: the ``fraction`` of the
    rows (rounded down) with the highest keys are sampled.

    The k-th highest key is found exactly by narrowing its range with counts, so no task
    sees more than its own rows. The noise depends on id and text, so rows with one key are equal
    rows; of those that tie with the k-th, as many are sampled as are wanted.
    """
    noise = gumbel(seed, "doc_id", "text")
    weighed = weigh(docs.select("doc_id", "text", noise.alias("_noise")), ratio).drop("text")
    key = F.col("log_weight") + F.lit(float(temperature)) * F.col("_noise")
    keyed = materialised(weighed.withColumn("key", key).drop("_noise"), "keys")
    wanted = int(keyed.count() * fraction)
    if not wanted:
        return keyed.withColumn("sampled", F.lit(False))
    bound = _kth_highest(keyed, wanted)
    above, tied = keyed.agg(F.count_if(F.col("key") > bound), F.count_if(F.col("key") == bound)).first()
    if above + tied == wanted:
        return keyed.withColumn("sampled", F.col("key") >= bound)
    # which of equal rows is taken makes no difference: they go by their place in the stage
    file = F.regexp_extract(F.col("_metadata.file_path"), r"part-(\d+)", 1).cast("double")
    placed = keyed.withColumn("_place", -(file * float(1 << 33) + F.col("_metadata.row_index")))
    last = _kth_highest(placed.filter(F.col("key") == bound).select(F.col("_place").alias("key")), wanted - above)
    taken = (F.col("key") > bound) | ((F.col("key") == bound) & (F.col("_place") >= last))
    return placed.withColumn("sampled", taken).drop("_place")


def _kth_highest(keyed: DataFrame, k: int, cells: int = 4096) -> float:
    """The k-th highest key, k being at least 1 and at most the number of rows."""
    low, high = keyed.agg(F.min("key"), F.max("key")).first()
    above = 0  # rows with keys over ``high``
    while low < high:
        width = (high - low) / cells
        if width <= 0 or low + width == low:
            break
        cell = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(cells - 1))
        inside = keyed.filter(F.col("key").between(low, high)).groupBy(cell.alias("cell"))
        counted = inside.agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        for r in sorted(counted, key=lambda r: -r.cell):
            if above + r.n >= k:
                low, high = r.low, r.high
                break
            above += r.n
    return high
