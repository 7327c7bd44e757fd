"""Channel search by digests of phrases, and tables dealt in proportion to their size."""

from __future__ import annotations

from pyspark.sql import functions as F

from chanlake.catalog import base
from chanlake.operators.search import search_channels
from tests.conftest import rows


def test_phrases_of_any_length_match_as_words_in_a_row(spark):
    texts = ["a b c d e f", "f e d c b a", "a b  c; d, E", "ab c", "", None, "a a a", "c d e f"]
    channels = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    asked = ["a", "A B", "b c d e", "a b c d e f", "a b c d e f g", "a a", "", "...", None, "ab"]
    keywords = spark.createDataFrame([(k,) for k in asked + asked], "keyword string")
    got = rows(search_channels(channels, keywords, F.col("text")), "keyword", "id")

    def split(text):
        return [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split() if w]

    def holds(text, phrase):
        return any(text[i : i + len(phrase)] == phrase for i in range(len(text)))

    assert got == sorted(((k, i) for k in asked for i, t in enumerate(texts) if split(k) and holds(split(t), split(k))), key=repr)
    assert search_channels(channels, keywords.limit(0), F.col("text")).count() == 0


def test_no_text_is_copied_and_no_other_pair_is_made(spark):
    channels = spark.createDataFrame([(i, f"red lavender no{i}") for i in range(100)], "id long, text string")
    keywords = channels.select("text").withColumnRenamed("text", "keyword")  # 100 x 100 pairs share the longest word
    found = search_channels(channels, keywords, F.col("text"))
    plan = found.select("keyword", "id")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert found.count() == 100 and "contains(" not in plan


def test_phrases_of_channels_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Spark takes them for the smaller side, whose estimate leaves out how many phrases a text has."""
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.concat(F.lit("w"), F.pmod(F.col("id") * i, F.lit(3000)))))
    spark.range(300).withColumn("text", text).write.parquet(str(tmp_path / "channels"))
    spark.range(3000).select(F.concat(F.lit("W"), "id").alias("keyword"), F.lit("x" * 40).alias("note")).write.parquet(str(tmp_path / "keywords"))
    channels, keywords = spark.read.parquet(str(tmp_path / "channels")), spark.read.parquet(str(tmp_path / "keywords"))

    def searched():
        found = search_channels(channels, keywords.unionByName(keywords).distinct(), F.col("text")).select("keyword", "id")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        return rows(found), found._jdf.queryExecution().executedPlan().toString(), plan

    few, plan, _ = searched()
    assert len(few) == 300 * 200 - sum(200 - len({k * i % 3000 for i in range(1, 201)}) for k in range(300))
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan
    monkeypatch.setattr("chanlake.operators.search.FEW_KEYWORDS", 2999, raising=False)
    many, plan, hinted = searched()
    assert many == few and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, hinted


def test_tables_are_dealt_in_proportion_to_their_size(spark, tmp_path, monkeypatch):
    spark.range(20000).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(base, "SPREAD_BYTES", 2000)
    dealt = base.table(spark, str(tmp_path), "events", spread=True)
    assert dealt.rdd.getNumPartitions() > 4 * spark.sparkContext.defaultParallelism  # one for each core before
    assert dealt.count() == 20000
