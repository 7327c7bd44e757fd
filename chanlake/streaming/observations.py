"""Observations as a stream: an append-only log, hourly totals, array roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chanlake.operators.observe import hourly_observations
from chanlake.schemas import OBSERVATIONS, ddl

LATE_BY = "2 hours"


def read_observation_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(ddl(OBSERVATIONS)).json(path)


def hourly_stream(observations: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """Hourly totals per channel; an hour is emitted once no later than ``late_by`` after it."""
    return hourly_observations(observations.withWatermark("queried_at", late_by))


def append_log(observations: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append observations to the log that the batch roll-up reads."""
    return (
        observations.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_hours(hours: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished hours to a table."""
    return (
        hours.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
