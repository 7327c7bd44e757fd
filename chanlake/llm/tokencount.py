"""Token counts through a digest cache.

The cache is a Parquet table of ``tokenizer, content, n_tokens``, one folder for each
tokenizer version. Counts of known contents are joined; only distinct unknown contents are
encoded, and appended for the next run.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20  # text encoded in one call
KNOWN_PIECES = 400_000  # pieces of text whose counts a task remembers
_SCHEMA = "content binary, n_tokens long, tokenizer string"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    name = f"{library.__name__}-{library.__version__}".encode()
    return hashlib.sha256(name + b"\0" + Path(path).read_bytes()).hexdigest()


def load_counter(path: str):
    """A function from texts to their numbers of tokens, by the library of the file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if _splits_at_blanks(tokenizer):
        return _by_pieces(tokenizer)
    return lambda texts: [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _splits_at_blanks(tokenizer) -> bool:
    """Whether a blank between two other characters always starts a new word of the
    tokenizer: true of the byte-level splitting pattern without changes to the text."""
    parts = json.loads(tokenizer.to_str())
    words = parts["pre_tokenizer"] or {}
    return (
        parts["normalizer"] is None
        and words.get("type") == "ByteLevel"
        and words.get("use_regex", True)
        and not words.get("add_prefix_space", True)
    )


def _by_pieces(tokenizer):
    """Counts by the library, each different piece of text encoded once for a task.

    Pieces start at a blank between two characters that are not white space, so no word of
    the tokenizer reaches over two of them. Texts with added tokens are encoded whole.
    """
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    cut = re.compile(r"(?<=\S)(?= \S)").split
    known: dict[str, int] = {}

    def count(texts):
        if len(known) > KNOWN_PIECES:
            known.clear()
        cuts = [[] if any(a in t for a in added) else cut(t) for t in texts]
        new = list({piece for pieces in cuts for piece in pieces} - known.keys())
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            known.update(zip(some, map(len, tokenizer.encode_batch_fast(some, add_special_tokens=False)), strict=True))
        return [
            sum(map(known.__getitem__, pieces)) if pieces else len(tokenizer.encode(text, add_special_tokens=False))
            for text, pieces in zip(texts, cuts, strict=True)
        ]

    return count


def encode(texts: DataFrame, path: str) -> DataFrame:
    """``content, n_tokens`` of ``content, text``; ``path`` has to be there on the workers."""

    def work(batches):
        count = load_counter(path)
        for batch in batches:
            counts, held, size = [], [], 0
            for text in batch.column(1):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size >= BATCH_BYTES:
                    counts += count(held)
                    held, size = [], 0
            if held:
                counts += count(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    return texts.select("content", "text").mapInArrow(work, "content binary, n_tokens long")


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of a tokenizer version; a content stored twice (by jobs that ran at
    the same time) counts once. A missing cache is empty."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    stored = spark.read.schema(_SCHEMA).parquet(cache) if there else spark.createDataFrame([], _SCHEMA)
    own = stored.filter(F.col("tokenizer") == version)
    return own.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """Every row with ``n_bytes`` (UTF-8) and ``n_tokens``; ``cache`` is a folder all can reach.

    The content key is the SHA-256 of the text's UTF-8 bytes, null as empty; nothing else is
    normalised, as any other change could change the count. Special strings inside texts are
    handled as the library does by default. Copies of a text are encoded once, repeated rows
    stay, and a second run encodes nothing. A job that fails before its append has stored
    nothing. Existing columns of the names added are replaced.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    docs = docs.drop("n_bytes", "n_tokens").withColumn("_text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("_content", F.unhex(F.sha2("_text", 256)))
    known = read_cache(spark, cache, version)
    wanted = docs.select(F.col("_content").alias("content"), F.col("_text").alias("text"))
    misses = (
        wanted.join(known.select("content"), "content", "left_anti")
        .groupBy("content")
        .agg(F.first("text").alias("text"))  # all texts of a digest are equal
    )
    fresh = encode(misses, tokenizer).withColumn("tokenizer", F.lit(version))
    fresh.write.mode("append").partitionBy("tokenizer").parquet(cache)
    stored = read_cache(spark, cache, version).withColumnRenamed("content", "_content")
    sized = docs.withColumn("n_bytes", F.octet_length("_text").cast("bigint")).drop("_text")
    return sized.join(stored, "_content").drop("_content")
