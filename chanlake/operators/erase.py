"""Erasing deleted or private channels from every table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.operators.locations import KEY_BLOCK, index_path
from chanlake.session import discard, stages
from chanlake.sources.paths import list_exists
from chanlake.sources.tables import BUCKET, DEFAULT_BUCKETS, MONTH, bucket_of, create_empty, folder_name


def erase_channels(df: DataFrame, tombstones: DataFrame, key: str = "channel_id") -> DataFrame:
    """Rows of channels that are not to be erased."""
    gone = tombstones.select(F.col("channel_id").alias(key)).distinct()
    return df.join(gone, key, "left_anti")


def erase_from_map(
    channel_originals: DataFrame, tombstones: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Per-channel map rows that stay, and the merged map of what they still use.

    An original leaves the merged map when no remaining channel uses it.
    """
    kept = erase_channels(channel_originals, tombstones)
    return kept, kept.select("original", "hash").distinct()


def erase_from_table(
    table: DataFrame, path: str, tombstones: DataFrame, buckets: int = DEFAULT_BUCKETS
) -> None:
    """Rewrite the buckets of a stored table that hold erased channels.

    Only those buckets are read and replaced. A folder left without rows is removed, and so
    is the stage of what is kept. The side table of places is treated alike, after the table.
    """
    _erase_folders(table.sparkSession, path, tombstones, buckets)
    if list_exists(table.sparkSession, index_path(path)):
        _erase_folders(table.sparkSession, index_path(path), tombstones, buckets)


def _erase_folders(spark: SparkSession, path: str, tombstones: DataFrame, buckets: int) -> None:
    touched = tombstones.select(bucket_of("channel_id", buckets).alias(BUCKET)).distinct()
    numbers = [row[0] for row in touched.collect()]  # at most ``buckets`` integers
    if not numbers:
        return
    saved = spark.read.parquet(path)
    folders = [c for c in (BUCKET, MONTH, KEY_BLOCK) if c in saved.columns]
    hit = saved.filter(F.col(BUCKET).isin(numbers))
    with stages(spark) as stage:
        kept = stage(erase_channels(hit, tombstones), "kept")
        emptied = stage(
            hit.select(folder_name(folders).alias("name"))
            .distinct()
            .join(kept.select(folder_name(folders).alias("name")), "name", "left_anti"),
            "emptied",
        )
        (
            kept.hint("rebalance", *folders)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(path)
        )
        for row in emptied.collect():  # at most one short name for each bucket and month
            discard(spark, f"{path.rstrip('/')}/{row.name}")
    if spark.read.schema(saved.schema).parquet(path).isEmpty():
        create_empty(saved, path, folders)
