"""Keeping hot keys from landing in one task.

Assumption throughout: one key may hold a third of all rows. Joins need no help: the adaptive
skew join, which the session settings switch on, splits partitions that grow too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def global_rank(df: DataFrame, order: list[str], name: str = "rank", parts: int = 0) -> DataFrame:
    """Number all rows 1, 2, ... in the given order without gathering them in one task.

    ``order`` must identify a row. Range-sorted parts are written once; each row's
    place in its part plus the sizes of the parts before it is its rank. Only the
    part sizes, one row per part, go through a single window.
    """
    from chanlake.session import materialised

    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    sorted_parts = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(place, 33))
        .withColumn("_place", place.bitwiseAND((1 << 33) - 1))
    )
    stored = materialised(sorted_parts, "ranked")
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select(
        "_part",
        F.expr("sum(_size) OVER (ORDER BY _part) - _size").alias("_before"),
    )
    return (
        stored.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_part", "_place", "_before")
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column], rows: int = 1) -> DataFrame:
    """One row per key, the first in ``order``, or the first ``rows``.

    ``row_number() <= rows`` is cut to so many per key on the map side before the shuffle,
    so many copies of one key do not meet in one task.
    """
    from pyspark.sql import Window

    ranked = df.withColumn(
        "_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_row") <= rows).drop("_row")
