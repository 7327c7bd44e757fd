"""From raw documents to training shards: five stages, each written as Parquet and reread.

A stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All
but the last return the columns of ``documents`` with their values, extra ones included,
whatever their names; the last replaces ``size``, ``shard`` and ``slot``. Rows without an id
are kept unless their text is rejected. An empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chanlake.llm import decontaminate, langid, mixing, neardup, sharding
from chanlake.llm.catalog import fold, table
from chanlake.llm.rows import numbered, row_digest
from chanlake.llm.ship import ship
from chanlake.session import configure, materialised, scratch

NEAR = (80, 100)  # similarity of word shingles from which documents are near-duplicates
NEAR_DISTANCE = 29  # of their signatures
ROW, DIGEST, LEFT = "_row_of_pipeline", "_digest_of_pipeline", "_left_of_pipeline"


def _carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns and all others in ``_others``: no name clashes with an operator's own."""
    others = [c for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(*others).alias("_others")) if others else docs.select(*needed)


def _restored(rows: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """The columns of ``docs`` with their own values."""
    return rows.select(*(F.col(c) if c in needed else F.col("_others").getField(c).alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that was learned; those the identifier rejects go.

    It learns from the labelled rows of its own input.
    """
    configure(ship(spark))
    model = langid.train(docs.filter(fold("doc_id", 5) != 0).select("doc_id", "text", "lang"))
    found = langid.identify(_carried(docs, "doc_id", "text"), model)
    return _restored(found.filter(~F.col("rejected")), docs, "doc_id", "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: one with the smallest id (null last), whether ids are
    absent, come twice, or not.

    Rows are numbered in a copy of their ids and texts that is deleted here. What goes is told by the
    digest of id and text, with the number of rows that stay: equal rows are alike, and at most one stays.
    """
    configure(ship(spark))
    digest = row_digest("doc_id", "text")
    with scratch(spark):
        rows = numbered(docs.select("doc_id", "text"), ROW).withColumn(DIGEST, digest)
        found = neardup.near_duplicates(rows.select(ROW, "text"), ROW, threshold=NEAR, distance=NEAR_DISTANCE)
        stay = rows.select(ROW, DIGEST).join(found.select(ROW, "kept").hint("merge"), ROW)
        left = stay.groupBy(DIGEST).agg(F.count_if("kept").alias(LEFT), F.count_if(~F.col("kept")).alias("_gone"))
        left = materialised(left.filter("_gone > 0").select(DIGEST, LEFT), "near-left", keep=True)
    marked = docs.withColumn(DIGEST, digest).join(left.hint("merge"), DIGEST, "left")  # grows with the corpus: never broadcast
    place = F.row_number().over(Window.partitionBy(DIGEST).orderBy(DIGEST))
    staying = marked.withColumn("_place", place).filter(F.col(LEFT).isNull() | (F.col("_place") <= F.col(LEFT)))
    return staying.select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    rows = docs.withColumn(ROW, row_digest("doc_id", "text"))
    found = decontaminate.contamination(rows.select(ROW, "text"), table(spark, sf_dir, "benchmark"), id_column=ROW)
    gone = found.filter("contaminated").select(ROW).distinct()
    return rows.join(gone.hint("merge"), ROW, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix in the order of its positions; a document has a row for each copy."""
    configure(spark)
    needed = ("doc_id", "source", "text")
    mixed = mixing.curriculum(_carried(docs, *needed))
    return _restored(mixing.training_order(mixed), docs, *needed)


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``size``, ``shard`` and ``slot``."""
    configure(spark)
    return sharding.shard(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard_documents),
]

# Centroids and best fit decreasing have no SQL: tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return docs
