"""Planning what is still to be collected, by month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlake.functions.dates import month_bins, period_name


def expected_periods(channels: DataFrame, cutoff: Column) -> DataFrame:
    """``channel_id, period, start, end`` of every whole month up to the cutoff."""
    return channels.select(
        "channel_id", F.explode(month_bins(F.col("date"), cutoff)).alias("bin")
    ).select(
        "channel_id",
        period_name(F.col("bin")).alias("period"),
        F.col("bin.start").alias("start"),
        F.col("bin.end").alias("end"),
    )


def last_saved_period(saved: DataFrame) -> DataFrame:
    """The last period of each channel, in the order of period names."""
    return saved.groupBy("channel_id").agg(F.max("period").alias("period"))


def missing_periods(expected: DataFrame, saved: DataFrame) -> DataFrame:
    """Periods to fetch: those with no saved file, and the last saved one again."""
    keys = ["channel_id", "period"]
    have = saved.select(*keys).distinct()
    missing = expected.join(have, keys, "left_anti").withColumn("resumed", F.lit(False))
    resumed = expected.join(last_saved_period(have), keys, "left_semi").withColumn(
        "resumed", F.lit(True)
    )
    return missing.unionByName(resumed)


def periods_to_fetch(channels: DataFrame, cutoff: Column, saved: DataFrame) -> DataFrame:
    """``resume_offsets`` of the ``missing_periods`` of channels with their ``date``: ``channel_id,
    period, start, end, resumed, offset_id``.

    What is saved of a channel, its periods' names and the last one's largest id, is joined with the
    channel; the expected periods are made after that and never moved.
    """
    have = saved.groupBy("channel_id").agg(
        F.collect_set("period").alias("_have"), F.max(F.struct("period", "id")).alias("_last")
    )
    named = F.transform(
        month_bins(F.col("date"), cutoff),
        lambda b: F.struct(period_name(b).alias("period"), b["start"].alias("start"), b["end"].alias("end")),
    )
    expected = channels.join(have, "channel_id", "left").select(
        "channel_id", "_have", "_last", F.explode(named).alias("bin")
    )
    missing = ~F.coalesce(F.array_contains("_have", F.col("bin.period")), F.lit(False))
    resumed = F.coalesce(F.col("bin.period") == F.col("_last.period"), F.lit(False))
    offset = F.when(resumed, F.coalesce("_last.id", F.lit(0))).otherwise(0).cast("bigint")
    return expected.filter(missing | resumed).select(
        "channel_id", "bin.*", resumed.alias("resumed"), offset.alias("offset_id")
    )


def high_water_mark(messages: DataFrame, keys: tuple[str, ...] = ("channel_id",)) -> DataFrame:
    """The largest saved message id per key."""
    return messages.groupBy(*keys).agg(F.max("id").alias("last_id"))


def resume_offsets(fetch: DataFrame, messages: DataFrame) -> DataFrame:
    """Periods to fetch with the id to go on after: 0 unless a saved period is resumed."""
    marks = high_water_mark(messages, ("channel_id", "period"))
    joined = fetch.join(marks, ["channel_id", "period"], "left")
    offset = F.when(F.col("resumed"), F.coalesce("last_id", F.lit(0))).otherwise(0)
    return joined.withColumn("offset_id", offset.cast("bigint")).drop("last_id")


def nth_to_last(
    messages: DataFrame, n: int = 1, keys: tuple[str, ...] = ("channel_id", "period")
) -> DataFrame:
    """The n-th row from the end of each group by id; the first if there are fewer.

    The map side keeps n rows per group, so a huge group is never sorted in one task.
    """
    window = Window.partitionBy(*keys).orderBy(F.desc("id"))
    last = messages.withColumn("_row", F.row_number().over(window)).filter(F.col("_row") <= n)
    others = [c for c in messages.columns if c not in keys]
    return (
        last.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), "_row").alias("_pick"))
        .select(*keys, "_pick.*")
    )
