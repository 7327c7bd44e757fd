"""Edges, priorities, the snowball against a small queue, and skew helpers."""

from __future__ import annotations

import heapq
import random
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from chanlake.operators import graph as G
from chanlake.operators.neighbours import NeighbourSets
from chanlake.operators.skew import (
    global_rank,
    latest_per_key,
)
from tests.conftest import rows


def test_pages_keep_all_rows_and_bound_groups(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    paged = G.adjacency(df.withColumn("v", F.col("v").cast("string")), "k", "v", "members", 100)
    assert paged.agg(F.sum(F.size("members"))).first()[0] == 1000
    sizes = paged.select("k", "depth", "page", F.size("members").alias("count"))
    assert sizes.agg(F.max("count")).first()[0] < 200
    assert sizes.filter("k='hot'").count() == 16 and sizes.filter("k='hot' and depth!=4").count() == 0
    assert sizes.filter("k!='hot' and (page!=0 or depth!=0)").count() == 0


def test_neighbour_sets_of_any_size_are_one_set(spark, tmp_path):
    sets = NeighbourSets(spark, str(tmp_path / "sets"), buckets=4)
    many = spark.range(1_000_000).select(F.lit("hub").alias("channel_id"), F.concat(F.lit("n"), "id").alias("member"))
    few = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "z"), ("c", None)], "channel_id string, member string")
    sets.add(many.limit(9_000).unionByName(few))
    assert sets.pages().filter("depth > 0").count() == 0
    before = {f for f in sets.pages().inputFiles()}
    sets.add(many.unionByName(few))
    assert sorted(tuple(r) for r in sets.sizes().collect()) == [("a", 2), ("b", 1), ("hub", 1_000_000)]
    pages = sets.pages().filter("channel_id = 'hub'")
    assert pages.select("depth").distinct().count() == 1 and pages.agg(F.max(F.size("members"))).first()[0] < 12_000
    hub = sets.members_of(many.limit(1))
    assert hub.count() == hub.distinct().count() == 1_000_000 and hub.join(many, ["channel_id", "member"], "left_anti").count() == 0
    asked = spark.createDataFrame([("hub", "n5"), ("hub", "n-5"), ("a", "x"), ("d", "x")], "channel_id string, member string")
    assert sorted(tuple(r) for r in sets.absent(asked).collect()) == [("d", "x"), ("hub", "n-5")]
    assert before & set(sets.pages().inputFiles()) or len(before) == 1  # other buckets stay
    files = set(sets.pages().inputFiles())
    sets.add(few)  # nothing new: nothing is written
    assert set(sets.pages().inputFiles()) == files


def test_sources_are_staged_once_for_their_pairs(spark):
    pairs = spark.range(240_000).coalesce(1).select(
        F.concat(F.lit("c"), "id").alias("channel_id"), F.sha2((F.col("id") % 30_000).cast("string"), 256).alias("source_id")
    )
    known = spark.range(10).select(F.col("id").cast("string").alias("original"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    found, missing = G.forward_sources(pairs, known)
    assert (found.count(), missing.count()) == (80, 239_920)
    assert found.select("original_id").distinct().count() == 10
    size = sum(Path(unquote(urlparse(f).path)).stat().st_size for f in found.inputFiles())
    assert size < 240_000 * 32  # the hash of each pair takes 64


def test_global_rank(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("v"), F.lit(1).alias("c"))
    ranked = global_rank(df, ["c", "v"])
    assert rows(ranked.filter("rank != v + 1"), "v") == []
    assert ranked.count() == 500


def test_latest_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    latest = latest_per_key(df, ["k"], [F.desc("id")])
    assert rows(latest, "k", "id") == [(0, 99), (1, 97), (2, 98)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def queue_model(edges, nodes, seeds, private=G.PRIVATE_PRIORITY):
    """One channel at a time from a heap; only for small graphs in this test."""

    def score(node, parent):
        has_doc, spam, language = nodes[node]
        if not has_doc:
            return private
        if spam:
            return private - 1
        return parent + G.LANGUAGE_STEPS.get(language, G.DEFAULT_LANGUAGE_STEP)

    out, linked = {}, {}
    for src, dst, kind in edges:
        (linked if kind == G.LINKED else out).setdefault(src, set()).add(dst)
    queued = {s: score(s, 0) for s in seeds if nodes[s][0]}
    heap = [(p, s) for s, p in queued.items()]
    heapq.heapify(heap)
    processed, priority = set(), {}
    while heap:
        p, node = heapq.heappop(heap)
        if node in priority:
            continue
        priority[node] = p
        found = {}
        for chat in [node, *sorted(linked.get(node, ()))]:
            if not nodes[chat][0]:
                continue
            for dst in out.get(chat, ()):
                found[dst] = min(found.get(dst, private), score(dst, p))
            processed.add(chat)
        for dst, q in found.items():
            if q < private and dst not in priority:
                heapq.heappush(heap, (q, dst))
    return priority


@pytest.mark.parametrize("seed", range(3))
def test_snowball_equals_a_queue(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:02d}" for i in range(40)]
    nodes = {
        n: (rng.random() > 0.15, rng.random() < 0.1, rng.choice(["EN", "FR", None, "XX"]))
        for n in names
    }
    edges = [
        (rng.choice(names), rng.choice(names), rng.choice([G.FORWARD, G.RECOMMEND]))
        for _ in range(90)
    ]
    for a, b in (("n00", "n01"), ("n10", "n11")):
        edges += [(a, b, G.LINKED), (b, a, G.LINKED)]
    seeds = names[:3]
    got = G.snowball(
        spark.createDataFrame(edges, "src string, dst string, kind string"),
        spark.createDataFrame(
            [(n, *v) for n, v in nodes.items()],
            "channel_id string, has_doc boolean, spam boolean, language string",
        ),
        spark.createDataFrame([(s,) for s in seeds], "channel_id string"),
    )
    expected = queue_model(edges, nodes, seeds)
    assert dict(rows(got, "channel_id", "priority")) == expected
    order = [r.channel_id for r in G.crawl_order(got).orderBy("rank").collect()]
    assert order == [n for _, n in sorted((p, n) for n, p in expected.items())]


def test_snowball_without_usable_seeds(spark):
    empty = G.snowball(
        spark.createDataFrame([("a", "b", "forward")], "src string, dst string, kind string"),
        spark.createDataFrame(
            [("a", False, None, None), ("b", True, False, "EN")],
            "channel_id string, has_doc boolean, spam boolean, language string",
        ),
        spark.createDataFrame([("a",)], "channel_id string"),
    )
    assert empty.count() == 0


def test_priority_threshold(spark):
    now = F.to_timestamp(F.lit("2024-01-11 00:00:00"))
    df = spark.sql(
        "select * from values (110, 100L, timestamp'2024-01-01'), (111, 100L, timestamp'2024-01-01'),"
        "(null, 100L, timestamp'2024-01-01') t(pts, participants, created)"
    ).selectExpr("pts", "participants", "created")
    spam = G.looks_like_spam(F.col("pts"), F.col("participants"), F.col("created"), now)
    got = df.select(G.exploration_priority(F.lit(True), spam, F.lit("EN"), F.lit(5)).alias("p"))
    # 110 / (1 + 100 * 11) is just below a tenth, 111 above
    assert [r.p for r in got.collect()] == [7, G.PRIVATE_PRIORITY - 1, None]


def test_recommended_by_is_the_transpose(spark):
    edges = [("a", "x", "recommend"), ("b", "x", "recommend"), ("a", "y", "recommend"), ("a", "x", "forward")]
    df = spark.createDataFrame(edges + edges[:1], "src string, dst string, kind string")
    got = G.recommended_by(df)
    assert rows(got, "channel_id", "recommended_by") == [("x", ["a", "b"]), ("y", ["a"])]


def test_frontier(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("a", 0), ("c", 0)], "channel_id string, priority long")
    assert [tuple(r) for r in G.frontier_order(df).collect()] == [("a", 0), ("c", 0), ("b", 1)]
    assert [r.channel_id for r in G.frontier_order(df, 1).collect()] == ["a"]


def _adjacency(spark, edges, page=G.PAGE_EDGES, buckets=3):
    rows = spark.createDataFrame(edges, "src string, dst string, fixed long, step long")
    return G.Adjacency(rows, "adjacency", buckets, page)


def test_a_hot_source_lies_in_pages(spark):
    edges = [("hub", f"d{i:04d}", None, 1) for i in range(1000)] + [("a", "b", None, 2)]
    adjacency = _adjacency(spark, edges, page=100)
    assert rows(adjacency.hot) == [("hub", 10)]
    stored = adjacency.stage.read().filter("src = 'hub'").groupBy("page").count().collect()
    assert len(stored) == 10 and max(r["count"] for r in stored) < 200
    asked = spark.createDataFrame([("hub", 5), ("a", 7), ("gone", 1)], "channel_id string, priority long")
    got = rows(adjacency.of(asked), "src", "dst", "priority", "step")
    assert got == sorted([("hub", f"d{i:04d}", 5, 1) for i in range(1000)] + [("a", "b", 7, 2)], key=repr)
    adjacency.drop()


def test_a_round_moves_its_frontier_only(spark):
    """Beyond the size of broadcasts, no exchange lies over the edges or the state."""
    from chanlake.session import BucketedStage, settings

    with settings(spark, {"spark.sql.shuffle.partitions": "3", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        links = _adjacency(spark, [("a", "l", None, None)])
        targets = _adjacency(spark, [("a", "b", None, 2), ("l", "c", None, 1), ("b", "a", None, 1)])
        state = BucketedStage(spark, "state", 3, ["channel_id"], ("round",))
        state.append(spark.createDataFrame([("a", 0, 0)], "channel_id string, priority long, round int"))
        found = G.improved(state.read(), links, targets, 0, G.PRIVATE_PRIORITY)
        assert rows(found) == [("b", 2, 1), ("c", 1, 1)]
        state.append(found)
        again = G.improved(state.read(), links, targets, 1, G.PRIVATE_PRIORITY)
        assert again.count() == 0
        # Each bucketed scan is reported with its buckets; an exchange above it would be by its key.
        plan = found._jdf.queryExecution().executedPlan().toString()
        for table in (links.stage.table, targets.stage.table):
            lines = plan.split("\n")
            at = next(i for i, line in enumerate(lines) if f".{table}" in line and "Scan" in line)
            depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
            above = []
            for line in reversed(lines[:at]):
                d = len(line) - len(line.lstrip(" :+-"))
                if d < depth:
                    above.append(line.strip(" :+-"))
                    depth = d
                    if "Join" in line:
                        break
            assert "Join" in above[-1] and not any("Exchange" in line for line in above), plan
            assert "Bucketed: true" in lines[at], plan
        for stage in (links, targets, state):
            stage.drop()
