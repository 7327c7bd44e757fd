"""Continuous message tables: new log files flow through the same transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chanlake.operators.upsert import MESSAGE_KEY
from chanlake.plans.message_tables import (
    PATH_TEMPLATE,
    MessageTables,
    merge_decoded,
    with_channel_and_period,
)
from chanlake.session import stages
from chanlake.sources.messages import (
    MESSAGE_FILES,
    decode,
    repair_concatenated_json,
    with_source,
)
from chanlake.sources.packs import unpacked
from chanlake.sources.tables import DEFAULT_BUCKETS
from chanlake.streaming.intervals import first_readings


MAX_FILE_AGE = "36500d"


def read_message_stream(
    spark: SparkSession,
    raw: str,
    files_per_trigger: int | None = None,
    template: str = PATH_TEMPLATE,
    files: str = MESSAGE_FILES,
    packs: bool = False,
) -> DataFrame:
    """Decoded records of files as they appear below ``raw``, good and bad. With ``packs`` the
    files hold many logs each."""
    reader = spark.readStream.option("pathGlobFilter", files).option("recursiveFileLookup", True)
    # by default the source skips files a week older than the newest one: an archive has those
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = with_source(reader.text(raw))
    lines = unpacked(lines) if packs else lines
    return with_channel_and_period(decode(repair_concatenated_json(lines)), template)


def stream_messages(
    spark: SparkSession,
    raw: str,
    tables: MessageTables,
    checkpoint: str,
    buckets: int = DEFAULT_BUCKETS,
    files_per_trigger: int | None = None,
    template: str = PATH_TEMPLATE,
    files: str = MESSAGE_FILES,
    packs: bool = False,
) -> StreamingQuery:
    """Upsert new files into the tables, batch by batch, until all present ones are in.

    The checkpoint remembers the files, and a repeated batch merges to the same rows. A file
    that is rewritten in place is not read again by a stream: ``build_message_tables`` does.
    """

    def merge(batch: DataFrame, _: int) -> None:
        with stages(batch.sparkSession) as stage:
            merge_decoded(stage(batch, "stream-batch"), tables, buckets)

    return (
        read_message_stream(spark, raw, files_per_trigger, template, files, packs)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(messages: DataFrame, arrival: str | None = None, delay: str = "1 day") -> DataFrame:
    """The first reading of each message.

    An archive is back-filled, so message dates do not follow arrival and are no watermark:
    by default keys are remembered for good, as intervals of ids. With an ``arrival`` column (a
    file's time) they are forgotten after ``delay``, and a later copy passes again.
    """
    if arrival is None:
        return first_readings(messages) if messages.isStreaming else messages.dropDuplicates(MESSAGE_KEY)
    return messages.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(MESSAGE_KEY)
