"""Channel documents to the channel table and the user table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.operators.flatten import flatten_channels, flatten_users
from chanlake.operators.upsert import replace_channels, upsert_channels
from chanlake.plans.message_tables import set_aside
from chanlake.schemas import CHANNELS
from chanlake.session import stages
from chanlake.sources.channels import (
    DOCUMENT_FILES,
    decode_channels,
    default_last_queried_at,
    scan_channel_texts,
)
from chanlake.sources.manifest import list_files, new_files, paths_to_read, remember
from chanlake.sources.messages import valid
from chanlake.sources.tables import DEFAULT_BUCKETS, latest_version, scan_table, write_version


def build_channel_tables(
    spark: SparkSession,
    docs: str,
    channels: str,
    users: str,
    version: str,
    buckets: int = DEFAULT_BUCKETS,
) -> str | None:
    """Bring the tables up to date; gives the new channel version's path, None if none.

    File versions that the manifest (``<channels>-files``) lacks are read. Of several
    documents of a channel the one with the newest file counts, in whatever order they
    arrive. What is no channel document goes to ``<channels>-quarantine``.
    """
    root = channels.rstrip("/")
    manifest = f"{root}-files"
    current = latest_version(spark, channels)
    saved = scan_table(spark, current, CHANNELS, ("source_modified",)) if current else None
    with stages(spark) as stage:
        listing = list_files(spark, docs, DOCUMENT_FILES)
        files = stage(listing if saved is None else new_files(listing, manifest), "files")
        texts = scan_channel_texts(spark, docs if saved is None else paths_to_read(files))
        decoded = stage(default_last_queried_at(decode_channels(texts)), "channel-docs")
        set_aside(decoded, f"{root}-quarantine")
        fresh = _newest_documents(valid(decoded), saved)
        path = None
        if not fresh.isEmpty():
            replace_channels(flatten_users(fresh), users, buckets)
            times = fresh.select(F.col("full_chat.id").alias("id"), F.col("file_modified").alias("source_modified"))
            rows = flatten_channels(fresh).join(times.dropDuplicates(["id"]), "id")
            path = write_version(upsert_channels(saved, rows), channels, version)
        remember(new_files(files, manifest), manifest)
    return path


def _newest_documents(docs: DataFrame, saved: DataFrame | None) -> DataFrame:
    """Documents with their channel's newest file time that are no older than the saved row."""
    own = F.col("full_chat.id").alias("_id")
    times = docs.groupBy(own).agg(F.max("file_modified").alias("_newest"))
    if saved is not None:
        known = saved.select(F.col("id").alias("_id"), F.col("source_modified").alias("_saved"))
        late = F.col("_newest") < F.col("_saved")
        times = times.join(known, "_id", "left").filter(~F.coalesce(late, F.lit(False))).drop("_saved")
    newest = docs.withColumn("_id", F.col("full_chat.id")).join(times, "_id")
    return newest.filter(F.col("file_modified") == F.col("_newest")).drop("_id", "_newest")
