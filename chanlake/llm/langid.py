"""Language identification by nearest centroid.

Texts are normalised TF-IDF vectors of hashed letter n-grams. Every language has several
centroids, found by spherical k-means, and a text gets the language of the centroid with
the highest cosine. A text is rejected if its cosine is below a floor between those of
texts of the language that the centroids were not fitted on and those of random letters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.llm.rows import row_digest
from chanlake.llm.ship import extended
from chanlake.operators.skew import latest_per_key

UNKNOWN = "und"
DIMENSIONS = 1 << 13
GRAMS = (1, 2, 3)
CENTROIDS = 4
SAMPLE = 400  # texts of a language that the centroids are fitted on, about
ROUNDS = 8
TAIL = 0.01  # of a language's texts that are not looked at for its floor, and of random ones
_PIECE = 64  # rows turned into vectors at once
_LETTER_BYTES = 1 << 22


def _letters() -> np.ndarray:
    """For each code point the letter it counts as: small letters, or a space for others."""
    codes = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            codes[code] = ord(low) if len(low) == 1 else code
    return codes


class Grams:
    """Counts of hashed letter n-grams of whole texts."""

    def __init__(self, dimensions: int = DIMENSIONS, grams: tuple[int, ...] = GRAMS):
        self.dimensions, self.grams, self.letters = dimensions, grams, _letters()

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """A row of counts for each text. Words are runs of letters, in blanks."""
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for i, text in enumerate(texts):
            if not text:
                continue
            for at in range(0, len(text), _LETTER_BYTES):  # pieces overlap by the longest n-gram
                out[i] += self._count(text[max(0, at - max(self.grams) + 1) : at + _LETTER_BYTES], at > 0)
        return out

    def _count(self, text: str, follows: bool) -> np.ndarray:
        codes = self.letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        lead = max(self.grams) - 1
        if not follows:
            codes = np.concatenate([np.full(lead, 32, np.uint32), codes, np.full(1, 32, np.uint32)])
        total = np.zeros(self.dimensions, np.int64)
        for n in self.grams:
            if len(codes) < lead + 1:
                break
            own = np.full(len(codes) - lead, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            last = codes[lead:]
            for k in range(n - 1, -1, -1):
                own = (own ^ codes[lead - k : len(codes) - k]) * np.uint32(0x85EBCA6B)
                own ^= own >> np.uint32(15)
            blank = last == 32
            if n > 1:
                blank &= codes[lead - 1 : -1] == 32
            total += np.bincount(own[~blank] % np.uint32(self.dimensions), minlength=self.dimensions)
        return total.astype(np.float32)

    def vectors(self, texts: list[str | None], idf: np.ndarray) -> np.ndarray:
        """Rows of length 1; a text without letters is a row of zeros."""
        values = np.log1p(self.counts(texts)) * idf
        norms = np.linalg.norm(values, axis=1, keepdims=True)
        return np.divide(values, norms, out=values, where=norms > 0)


@dataclass
class LanguageModel:
    labels: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: dict[str, float]  # cosines below are too far


def document_frequencies(texts: DataFrame, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, int]:
    """In how many of all ``text`` rows each hashed n-gram occurs, and the number of rows."""

    def count(batches):
        grams = Grams(dimensions)
        seen, rows = np.zeros(dimensions, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _PIECE):
                part = batch.column(0).slice(at, _PIECE).to_pylist()
                seen += (grams.counts(part) > 0).sum(axis=0)
                rows += len(part)
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(seen[found], rows))], names=["gram", "n"]
        )

    counted = texts.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    seen, rows = np.zeros(dimensions, np.int64), 0
    for r in counted.collect():  # no more rows than dimensions
        if r.gram < 0:
            rows = r.n
        else:
            seen[r.gram] = r.n
    return seen, rows


def cluster(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means, started from far apart rows; empty clusters are left out."""
    picks = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    nearest = vectors @ vectors[picks[0]]
    while len(picks) < min(k, len(vectors)):
        picks.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[picks[-1]])
    centers = vectors[picks]
    for _ in range(rounds):
        own = np.argmax(vectors @ centers.T, axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) for c in range(len(centers)) if (own == c).any()])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = sums / np.where(norms > 0, norms, 1)
    return centers


def random_letters(texts: list[str], seed: int = 7) -> list[str]:
    """The texts with every letter replaced by any of their letters, all equally likely."""
    letters = sorted({c for text in texts for c in set(text.lower()) if c.isalpha()})
    codes = np.array([ord(c) for c in letters], np.uint32)
    rng, out = np.random.default_rng(seed), []
    for text in texts:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        at = np.flatnonzero([c.isalpha() for c in text])
        points[at] = codes[rng.integers(0, len(codes), len(at))]
        out.append(points.tobytes().decode("utf-32-le", "surrogatepass"))
    return out


def unseen_cosines(vectors: np.ndarray, k: int) -> np.ndarray:
    """Cosines of each half of the rows with centroids fitted on the other half."""
    halves = vectors[::2], vectors[1::2]
    if not len(halves[1]):
        return np.empty(0)
    return np.concatenate([(a @ cluster(b, k).T).max(axis=1) for a, b in (halves, halves[::-1])])


def train(
    docs: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, dimensions: int = DIMENSIONS
) -> LanguageModel:
    """Learn from ``doc_id, text, lang``; rows without a language or letters are not used.

    Document frequencies come from all rows, the centroids of each language from ``sample`` of its
    rows (all, if fewer), those with the least hashes of id and text. A language's floor is the geometric
    mean of two cosines: what all but the lowest of its texts reach with centroids they were
    not fitted on, and what all but the highest of them reach with random letters. Without
    rows there are no languages and every text is unknown.
    """
    docs = docs.filter(F.col("lang").isNotNull() & has_letters("text"))
    seen, rows = document_frequencies(docs, dimensions)
    idf = (np.log((1 + rows) / (1 + seen)) + 1).astype(np.float32)
    drawn = docs.withColumn("_draw", F.pmod(F.xxhash64(F.lit("sample"), row_digest("doc_id", "text")), F.lit(1 << 30)))
    sizes = drawn.groupBy("lang").agg(F.count("*").alias("_n"), F.min("_draw").alias("_least"))  # a row a language
    # few rows are ordered; the rank, not the draw, is what bounds a language's sample
    likely = (F.col("_draw") / float(1 << 30) * F.col("_n") < 4 * sample) | (F.col("_draw") == F.col("_least"))
    picked = latest_per_key(drawn.join(F.broadcast(sizes), "lang").filter(likely), ["lang"], [F.col("_draw")], sample)

    def fit(table: pa.Table) -> pa.Table:
        grams = Grams(dimensions)
        texts = sorted(table["text"].to_pylist())  # reruns agree

        def vectors(rows):
            return np.concatenate([grams.vectors(rows[at : at + _PIECE], idf) for at in range(0, len(rows), _PIECE)])

        values = vectors(texts)
        centers = cluster(values, centroids).astype(np.float32)
        floor = random = max(float(np.quantile((vectors(random_letters(texts)) @ centers.T).max(axis=1), 1 - TAIL)), 0.0)
        if len(unseen := unseen_cosines(values, centroids)):
            floor = float(np.sqrt(random * max(np.quantile(unseen, TAIL), 0.0)))
        return pa.table(
            {
                "lang": pa.array([table["lang"][0].as_py()] * len(centers), pa.string()),
                "center": pa.array([c.tobytes() for c in centers], pa.binary()),
                "floor": pa.array([floor] * len(centers)),
            }
        )

    fitted = (
        picked.select("text", "lang")
        .groupBy("lang")
        .applyInArrow(fit, "lang string, center binary, floor double")
        .collect()  # a few rows of fixed size for each language
    )
    fitted.sort(key=lambda r: (r.lang, r.center))
    centers = np.array([np.frombuffer(r.center, np.float32) for r in fitted], np.float32)
    return LanguageModel(
        [r.lang for r in fitted], centers.reshape(-1, dimensions), idf, {r.lang: r.floor for r in fitted}
    )


def has_letters(text: str):
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Every row with ``lang_pred``, ``score`` (the cosine, 0 to 1) and ``rejected``.

    Texts that are null or have no letters are ``und`` with score 0 and rejected, and so are
    all texts if nothing was learned. Others get the nearest language; ``rejected`` says that
    the text is too far from it to be trusted. Equal cosines go to the language that comes
    first. Existing columns of the names added are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected").withColumn("_letters", has_letters("text"))
    schema = extended(docs, lang_pred="string", score="double", rejected="boolean")
    text_at, letters_at = docs.columns.index("text"), docs.columns.index("_letters")
    floors = np.array([model.floors[label] for label in model.labels])

    def work(batches):
        grams = Grams(model.centroids.shape[1])
        for batch in batches:
            for at in range(0, batch.num_rows, _PIECE):
                part = batch.slice(at, _PIECE)
                rows, letters = part.num_rows, np.asarray(part.column(letters_at))
                if len(model.labels):
                    cosines = grams.vectors(part.column(text_at).to_pylist(), model.idf) @ model.centroids.T
                    best = np.argmax(cosines, axis=1)
                    score = np.clip(cosines[np.arange(rows), best].astype(np.float64), 0, 1)
                    far = score < floors[best]
                    names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
                else:
                    score, far, names = np.zeros(rows), np.ones(rows, bool), [UNKNOWN] * rows
                added = [
                    pa.array(names, pa.string()),
                    pa.array(np.where(letters, score, 0.0)),
                    pa.array(far | ~letters),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=schema.names)

    return docs.mapInArrow(work, schema).drop("_letters")
