"""Repeated observations of messages: how counters change over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanlake.operators.skew import latest_per_key

SAMPLE_CAP = 100  # messages followed per channel before admission stops
MESSAGE = ["channel_id", "id"]
METRICS = ("views", "forwards", "edit_date", "reactions", "replies")


def observation_arrays(observations: DataFrame) -> DataFrame:
    """Parallel arrays per message and month of observation (``page``, as yyyy-MM), in order
    of query time; null metrics keep their place.

    The page is a fixed window of time, so a row does not depend on how often others were
    observed, and hourly observation fills at most 744 places.
    """
    paged = observations.withColumn("page", F.date_format("queried_at", "yyyy-MM"))
    step = F.struct(
        "queried_at",
        "views",
        "forwards",
        "edit_date",
        # Maps cannot be ordered: their entries can.
        F.array_sort(F.map_entries("reactions")).alias("reactions"),
        F.coalesce("replies", F.lit(0)).alias("replies"),
    )
    rolled = paged.groupBy(*MESSAGE, "page").agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    return rolled.select(
        *MESSAGE,
        "page",
        *(
            F.col(f"_steps.{name}").alias(name)
            for name in ("queried_at", "views", "forwards", "edit_date", "replies")
        ),
        F.transform("_steps", lambda s: F.map_from_entries(s["reactions"])).alias("reactions"),
    )


def newest_pull(pull: DataFrame) -> DataFrame:
    """One row per message of a pull, the last one queried."""
    return latest_per_key(pull, MESSAGE, [F.desc("queried_at"), F.desc_nulls_last("views")])


def latest_vs_saved(
    saved: DataFrame, pull: DataFrame, mark_deleted: bool = False
) -> DataFrame:
    """Saved observations of messages the newest pull still has.

    Messages gone from the pull are dropped, or kept with ``deleted`` set.
    """
    present = newest_pull(pull).select(*MESSAGE, F.lit(False).alias("_gone"))
    if not mark_deleted:
        return saved.join(present, MESSAGE).drop("_gone")
    marked = saved.join(present, MESSAGE, "left")
    return marked.withColumn("deleted", F.coalesce("_gone", F.lit(True))).drop("_gone")


def append_pull(saved: DataFrame, pull: DataFrame, mark_deleted: bool = False) -> DataFrame:
    """The saved observations still followed, with the new ones of the same messages."""
    kept = latest_vs_saved(saved, pull, mark_deleted)
    followed = saved.select(*MESSAGE).distinct()
    new = newest_pull(pull).join(followed, MESSAGE, "left_semi")
    return kept.unionByName(new, allowMissingColumns=True)


def hourly_observations(observations: DataFrame) -> DataFrame:
    """Per channel and hour: rows, messages' views and forwards in total.

    Works on a stream with a watermark as on a table.
    """
    hour = F.window("queried_at", "1 hour")
    return (
        observations.groupBy("channel_id", hour.alias("_hour"))
        .agg(
            F.count("*").alias("observations"),
            F.sum("views").alias("views"),
            F.sum("forwards").alias("forwards"),
            F.max("queried_at").alias("last_queried_at"),
        )
        .select(
            "channel_id",
            F.col("_hour.start").alias("hour_start"),
            F.col("_hour.end").alias("hour_end"),
            "observations",
            "views",
            "forwards",
            "last_queried_at",
        )
    )


def admitted_hours(
    messages: DataFrame, cap: int = SAMPLE_CAP, date: str = "date", followed: DataFrame | None = None
) -> DataFrame:
    """Channel hours in which new messages are still taken in.

    An hour is admitted as a whole while fewer than ``cap`` messages were taken in
    before it, those of earlier rounds included: ``followed`` has ``channel_id, followed``.
    The running total goes over hourly counts, not over messages.
    """
    hour = F.date_trunc("hour", date).alias("_hour")
    counts = messages.groupBy("channel_id", hour).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("channel_id").orderBy("_hour").rowsBetween(
        Window.unboundedPreceding, -1
    )
    total = F.coalesce(F.sum("_n").over(before), F.lit(0))
    if followed is not None:
        counts = counts.join(followed, "channel_id", "left")
        total = total + F.coalesce("followed", F.lit(0))
    return counts.withColumn("_before", total).drop("followed").filter(F.col("_before") < cap)


def sample_cap(
    messages: DataFrame, cap: int = SAMPLE_CAP, date: str = "date", followed: DataFrame | None = None
) -> DataFrame:
    """New messages that enter the sample: a channel stops once it follows ``cap``.

    The admitted hours of a channel are its first ones up to a point, so one time per
    channel decides: the end of its last admitted hour.
    """
    hours = admitted_hours(messages, cap, date, followed)
    last = hours.groupBy("channel_id").agg(F.max("_hour").alias("_last"))
    joined = messages.join(last, "channel_id")
    return joined.filter(F.date_trunc("hour", date) <= F.col("_last")).drop("_last")
