"""Channel documents: one JSON object per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.schemas import CHANNEL_DOC, CORRUPT, ddl
from chanlake.sources.paths import list_exists

DOCUMENT_FILES = "*.json"


def scan_channel_texts(
    spark: SparkSession, path: str | list[str], modified_after: str | None = None
) -> DataFrame:
    """Documents as text, of a folder or of the files listed; an absent folder gives no rows."""
    if not path or (isinstance(path, str) and not list_exists(spark, path)):
        return spark.createDataFrame(
            [], "value string, file_path string, file_modified timestamp"
        )
    reader = spark.read.option("pathGlobFilter", DOCUMENT_FILES).option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.text(path, wholetext=True).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


def decode_channels(texts: DataFrame, value: str = "value") -> DataFrame:
    """Typed channel documents.

    ``full_keys`` lists the keys the full half really has, so that a null there can be
    told from an absent key when both halves are merged. Documents that do not decode
    keep a reason in ``decode_error``.
    """
    fields = ddl({**CHANNEL_DOC, CORRUPT: "string"})
    record = F.from_json(value, fields, {"columnNameOfCorruptRecord": CORRUPT})
    rows = texts.select("*", F.explode(F.array(record)).alias("_record"))  # parsed once
    return rows.select(
        *(c for c in texts.columns),
        *(F.col(f"_record.{name}").alias(name) for name in CHANNEL_DOC),
        F.json_object_keys(F.get_json_object(value, "$.full_chat")).alias("full_keys"),
        F.when(F.col(f"_record.{CORRUPT}").isNotNull(), "not a channel document").alias(
            "decode_error"
        ),
    )


def scan_channels(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    texts = scan_channel_texts(spark, path, modified_after)
    return (
        decode_channels(texts)
        .filter(F.col("decode_error").isNull())
        .drop("decode_error", "value")
    )


def default_last_queried_at(docs: DataFrame) -> DataFrame:
    """Documents without a query time get their file's time."""
    queried: Column = F.coalesce(
        F.try_to_timestamp("last_queried_at"), F.col("file_modified").cast("timestamp")
    )
    return docs.withColumn("last_queried_at", queried)
