"""Bins and periods are made in their row and never moved."""

from __future__ import annotations

import datetime as dt
import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from chanlake.catalog import ENTRIES
from chanlake.operators import periods
from tests.conftest import rows


def test_periods_are_planned_channel_by_channel(spark):
    day = dt.datetime(2024, 1, 15)
    channels = spark.createDataFrame([("a", day), ("b", day), (None, day), ("d", None)], "channel_id string, date timestamp")
    names = [f"2024-0{m}-01_to_2024-0{m + 1}-01" for m in (1, 2, 3)]
    saved = spark.createDataFrame(
        [("a", names[0], 1), ("a", names[1], 5), ("a", names[1], 3), ("a", None, 9), (None, names[0], 7), ("x", names[0], 2)],
        "channel_id string, period string, id long",
    )
    cutoff = F.to_timestamp(F.lit("2024-04-10"))
    plan = periods.periods_to_fetch(channels, cutoff, saved)
    columns = ["channel_id", "period", "start", "end", "resumed", "offset_id"]
    old = periods.resume_offsets(periods.missing_periods(periods.expected_periods(channels, cutoff), saved), saved)
    assert rows(plan, *columns) == rows(old, *columns) and plan.count() == 8
    assert ("a", names[1], True, 5) in rows(plan, "channel_id", "period", "resumed", "offset_id")


def test_plans_of_bins_and_periods(spark, tmp_path):
    sf = str(tmp_path)
    spark.range(20).coalesce(1).select(F.col("id").alias("p_partkey")).write.parquet(f"{sf}/part.parquet")
    spark.range(20).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"), F.lit(dt.datetime(2000, 1, 5)).alias("o_orderdate")
    ).write.parquet(f"{sf}/orders.parquet")

    def plan(name):
        shown = io.StringIO()
        with redirect_stdout(shown):
            ENTRIES[name][0](spark, sf).explain()
        return shown.getvalue()

    bins = plan("hour_bins")
    assert "Generate" not in bins and "RoundRobin" in bins  # 337 rows a part in one task before
    for name in ("missing_periods", "resume_offsets"):
        above = plan(name).split("Generate")
        assert len(above) == 2 and "Exchange" not in above[0]  # no expected period is shuffled
