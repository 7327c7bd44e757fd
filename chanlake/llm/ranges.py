"""Running totals per key without gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS = 4096  # mean rows of a range; a range is the largest unit of one task
MIN_RANGES = 256


def digest(*columns: str) -> Column:
    """A reproducible shuffle order: the MD5 digest of the values as text."""
    return F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))


def range_count(rows: int) -> int:
    return max(MIN_RANGES, rows // RANGE_ROWS)


def running_total(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, ranges: int
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same keys before this row.

    ``order`` starts with a digest column (hex). Its leading digits cut every key into
    ``ranges`` parts, so a key with a third of all rows is still many small windows; the
    totals of the parts, at most ``ranges`` rows for a key, give the rest. Null keys are a key.
    """
    leading = F.conv(F.substring(order[0], 1, 7), 16, 10).cast("bigint")
    at = F.floor(leading * ranges / float(1 << 28)).cast("int")
    # one key column that is never null: the windows and the join are partitioned alike, so
    # whole rows are shuffled once
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    df = df.withColumns({"_key": key, "_range": at, "_value": value})
    totals = df.groupBy("_key", "_range").agg(F.sum("_value").alias("_sum"))
    by_range = Window.partitionBy("_key").orderBy("_range")
    before = F.sum("_sum").over(by_range) - F.col("_sum")
    totals = totals.select("_key", "_range", before.alias("_before"))
    inside = Window.partitionBy("_key", "_range").orderBy(*order)
    own = F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_value")
    joined = df.withColumn("_own", own).join(totals, ["_key", "_range"])
    return joined.withColumn(name, F.col("_own") + F.col("_before")).drop("_key", "_range", "_value", "_own", "_before")
