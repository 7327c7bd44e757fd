"""Connected components of a list of links, in rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlake.session import discard, materialised, write_stage


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest reachable node) for all nodes of ``a, b`` links.

    Each round is written in the shared folder and the one before it deleted, so no round
    is computed twice and a lost executor costs one round. Loops and repeats do no harm;
    no links, no rows.
    """
    spark = edges.sparkSession
    at = write_stage(_ordered(edges.select("a", "b")), "links")
    before = None
    while True:
        links = spark.read.parquet(at)
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if before == (state.n, state.s):
            break
        before = (state.n, state.s)
        new = write_stage(_small_star(_large_star(links)), "links")
        discard(spark, at)
        at = new
    stars = spark.read.parquet(at).select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    result = materialised(stars.unionByName(roots), "components")
    discard(spark, at)
    return result


def _ordered(edges: DataFrame) -> DataFrame:
    """Each link once, the larger node first."""
    return (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Link all larger neighbours of a node to the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return _ordered(
        both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link all smaller neighbours of a node, and the node, to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("m").alias("b"))))
