"""Sets of neighbours of any size, stored in pages that are fixed ranges of a hash.

A page of a set is addressed by a depth and the leading bits of its members' hashes. The depth of a
set is part of what is stored: it grows when the set does and never shrinks, so a page is split
into its two halves and no member ever changes to a range that does not lie in its old one. What a
reader sees is the set; how many pages it has is the table's own matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.session import stages
from chanlake.sources.paths import list_exists
from chanlake.sources.tables import BUCKET, DEFAULT_BUCKETS, bucket_of

PAGE_ROWS = 10_000
MAX_DEPTH = 40


def depth_for(members: Column, page_rows: int = PAGE_ROWS) -> Column:
    """Bits that cut a set into pages of ``page_rows`` members on average, or fewer."""
    bits = F.ceil(F.log2(F.greatest(members, F.lit(1)).cast("double") / F.lit(float(page_rows))))
    return F.least(F.greatest(bits, F.lit(0)), F.lit(MAX_DEPTH)).cast("int")


def page_of(value: Column, depth: Column) -> Column:
    """The first ``depth`` bits of the value's hash, as a number."""
    leading = F.shiftrightunsigned(F.xxhash64(value), 64 - MAX_DEPTH)
    return F.floor(leading / F.pow(F.lit(2.0), F.lit(MAX_DEPTH) - depth)).cast("bigint")


def in_pages(pairs: DataFrame, depths: DataFrame, key: str, value: str) -> DataFrame:
    """``key, depth, page, members``: distinct pairs as sorted pages; ``depths`` has those of the
    large sets (``key, depth``), all others have one page."""
    placed = pairs.join(depths, key, "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    paged = placed.withColumn("page", page_of(F.col(value), F.col("depth")))
    return paged.groupBy(key, "depth", "page").agg(F.array_sort(F.collect_list(value)).alias("members"))


class NeighbourSets:
    """A stored table of sets: ``channel_id`` to members, both text, in channel buckets."""

    COLUMNS = f"channel_id string, depth int, page bigint, members array<string>, {BUCKET} int"

    def __init__(self, spark: SparkSession, path: str, page_rows: int = PAGE_ROWS, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.path, self.page_rows, self.buckets = spark, path, page_rows, buckets

    def pages(self) -> DataFrame:
        if not list_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.COLUMNS)
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)

    def pairs(self) -> DataFrame:
        """``channel_id, member``: all sets, a row for each member."""
        return self.pages().select("channel_id", F.explode("members").alias("member"))

    def members_of(self, channels: DataFrame) -> DataFrame:
        """``channel_id, member`` of the sets asked for. Only their buckets are read."""
        asked = channels.select("channel_id").distinct()
        numbers = [r[0] for r in asked.select(bucket_of("channel_id", self.buckets)).distinct().collect()]
        own = self.pages().filter(F.col(BUCKET).isin(numbers)).join(asked, "channel_id", "left_semi")
        return own.select("channel_id", F.explode("members").alias("member"))

    def sizes(self) -> DataFrame:
        """``channel_id, n``; members are not looked at."""
        return self.pages().groupBy("channel_id").agg(F.sum(F.size("members")).cast("bigint").alias("n"))

    def absent(self, pairs: DataFrame) -> DataFrame:
        """The pairs that no set holds. A pair meets the one page of its range only."""
        pages = self.pages()
        depths = pages.filter("depth > 0").select("channel_id", "depth").distinct()
        placed = pairs.select("channel_id", "member").distinct().join(depths, "channel_id", "left")
        placed = placed.withColumn("page", page_of(F.col("member"), F.coalesce("depth", F.lit(0)))).drop("depth")
        known = pages.select("channel_id", "page", F.explode("members").alias("member"))
        return placed.join(known, ["channel_id", "page", "member"], "left_anti").drop("page")

    def add(self, pairs: DataFrame) -> None:
        """Add ``channel_id, member`` pairs. Pages that get no new member and are not split stay as they
        are; the buckets with new members are written anew, one after the other."""
        with stages(self.spark) as stage:
            fresh = stage(pairs.select("channel_id", "member").filter("channel_id IS NOT NULL AND member IS NOT NULL").distinct(), "pairs")
            fresh = stage(self.absent(fresh), "fresh")
            numbers = [r[0] for r in fresh.select(bucket_of("channel_id", self.buckets)).distinct().collect()]
            if not numbers:
                return
            old = self.pages().filter(F.col(BUCKET).isin(numbers)).drop(BUCKET)
            sizes = old.groupBy("channel_id").agg(F.sum(F.size("members")).alias("n"), F.max("depth").alias("was"))
            grown = fresh.groupBy("channel_id").agg(F.count("*").alias("more")).join(sizes, "channel_id", "left")
            total = F.col("more") + F.coalesce("n", F.lit(0))
            depth = F.greatest(F.coalesce("was", F.lit(0)), depth_for(total, self.page_rows))
            depths = stage(grown.select("channel_id", "was", depth.alias("depth")), "depths")
            split = depths.filter("was < depth").select("channel_id")
            # new members and, of sets that go deeper, all old ones by their new ranges
            moved = old.join(split, "channel_id", "left_semi").select("channel_id", F.explode("members").alias("member"))
            added = in_pages(fresh.unionByName(moved), depths.filter("depth > 0").select("channel_id", "depth"), "channel_id", "member")
            kept = old.join(split, "channel_id", "left_anti")
            address = ["channel_id", "depth", "page"]
            merged = kept.unionByName(added).groupBy(*address).agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("members"))
            rows = stage(merged, "pages").withColumn(BUCKET, bucket_of("channel_id", self.buckets))
            (
                rows.hint("rebalance", BUCKET)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BUCKET)
                .parquet(self.path)
            )
