"""Following messages over time: admit, append, roll up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chanlake.operators.observe import (
    MESSAGE,
    SAMPLE_CAP,
    newest_pull,
    observation_arrays,
    sample_cap,
)
from chanlake.schemas import OBSERVATIONS, ddl
from chanlake.session import stages
from chanlake.sources.paths import list_exists
from chanlake.sources.tables import (
    DEFAULT_BUCKETS,
    to_schema,
    versions,
    write_observations,
    write_version,
)


def track(
    spark: SparkSession,
    pull: DataFrame,
    new_messages: DataFrame,
    table: str,
    version: str,
    cap: int = SAMPLE_CAP,
) -> str:
    """One round: append what the pull says of followed messages, and admit new messages.

    ``pull`` re-observes followed messages, ``new_messages`` are first observations with
    their ``date``. The log only grows: a round writes its own rows and reads none of the
    earlier ones; ``observation_log`` tells which messages are still there. Every admission
    is remembered, so that messages that vanished still count against the cap. Versions are
    in order of their names. Gives the path of the round's rows. A round lost on the way can
    be repeated under its version.
    """
    before = admissions(spark, table, version)
    fresh = new_messages if before is None else new_messages.join(before, MESSAGE, "left_anti")
    followed = None if before is None else before.groupBy("channel_id").agg(F.count("*").alias("followed"))
    with stages(spark) as stage:
        admitted = stage(to_schema(sample_cap(fresh, cap, followed=followed), OBSERVATIONS), "admitted")
        write_version(admitted.select(*MESSAGE).distinct(), _admission_path(table), version)
        rows = admitted
        if before is not None:
            again = newest_pull(to_schema(pull, OBSERVATIONS)).join(before, MESSAGE, "left_semi")
            rows = rows.unionByName(again)
        return write_version(rows, table, version)


def observation_log(spark: SparkSession, table: str, mark_deleted: bool = False) -> DataFrame:
    """All observations of messages that every round since their admission has seen.

    With ``mark_deleted`` those of the other messages stay as well, and ``deleted`` tells
    whether the last round lacked the message. Rounds that did not end are not read.
    """
    rounds = versions(spark, table)  # one short name for each round
    numbers = spark.createDataFrame(list(zip(rounds, range(len(rounds)), strict=True)), "version string, _round int")
    log = spark.read.schema(ddl({**OBSERVATIONS, "version": "string"})).parquet(table)
    message = Window.partitionBy(*MESSAGE)
    # A round has one row of a message, but for the one that admitted it.
    marked = (
        log.join(numbers, "version")
        .withColumn("_first", F.min("_round").over(message))
        .withColumn("_later", F.sum((F.col("_round") > F.col("_first")).cast("int")).over(message))
        .withColumn("_last", F.max("_round").over(message))
    )
    newest = len(rounds) - 1
    if mark_deleted:
        return marked.select(*OBSERVATIONS, (F.col("_last") < newest).alias("deleted"))
    return marked.filter(F.col("_later") == newest - F.col("_first")).select(*OBSERVATIONS)


def _admission_path(table: str) -> str:
    return table.rstrip("/") + "-admitted"


def admissions(spark: SparkSession, table: str, version: str | None = None) -> DataFrame | None:
    """``channel_id, id`` of all messages that were ever taken in, by rounds other than ``version``."""
    path = _admission_path(table)
    if not list_exists(spark, path):
        return None
    rounds = spark.read.schema("channel_id string, id bigint, version string").parquet(path)
    return rounds.filter(F.col("version") != F.lit(version or "")).select(*MESSAGE).distinct()


def roll_up(
    spark: SparkSession, table: str, path: str, buckets: int = DEFAULT_BUCKETS
) -> None:
    """Write the observations of what is still there as one row of arrays per message and month."""
    write_observations(observation_arrays(observation_log(spark, table)), path, buckets)
