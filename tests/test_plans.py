"""Whole jobs on small fixtures, and the shape of plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from chanlake.functions.text import channel_text
from chanlake.operators.language import train_profiles
from chanlake.operators.word_index import WordIndex
from chanlake.plans.expansion import expand, record_issues
from chanlake.plans.keywords import search_round, write_round
from chanlake.plans.observations import admissions, observation_log, roll_up, track
from chanlake.schemas import CHANNEL_DOC, ddl
from chanlake.sources.tables import latest_version
from tests.conftest import rows

ENGLISH = "the quick brown fox jumps over the lazy dog and then the other thing that was there"
FRENCH = "le renard brun saute par dessus le chien paresseux et puis les autres choses qui étaient là"


def test_expansion(spark, tmp_path):
    import json

    def doc(name, about, pts=1, linked=(), **lists):
        chats = [{"id": name, "title": "t", "date": "2024-01-10T00:00:00+00:00"}]
        chats += [{"id": x, "title": "l"} for x in linked]
        full = {"id": name, "about": about, "pts": pts, "participants_count": 100}
        return json.dumps({"chats": chats, "full_chat": full, **lists})

    docs = [
        doc("a", ENGLISH, recommended_channels=["b"], forwards_from=["gone"]),
        doc("b", FRENCH, linked=["g"]),
        doc("g", ENGLISH, recommended_channels=["c"]),
        doc("c", FRENCH),
        doc("s", ENGLISH, pts=10**9),
        doc("far", ENGLISH),
        doc("blank", ENGLISH, pts=None),
    ]
    parsed = spark.createDataFrame([(d,) for d in docs], "v string").select(
        F.from_json("v", ddl(CHANNEL_DOC)).alias("d")
    ).select("d.*")
    messages = spark.createDataFrame(
        [("a", "2024-01-01_to_2024-02-01", 5, "PeerChannel", "s")],
        "channel_id string, period string, id long, fwd_from_type string, fwd_from_id string",
    )
    profiles = train_profiles(
        spark.createDataFrame([("en", ENGLISH), ("fr", FRENCH)], "language string, text string")
    )
    seeds, done = (spark.createDataFrame([("a",)], "channel_id string") for _ in range(2))
    now = F.to_timestamp(F.lit("2024-04-15 00:00:00"))
    step = expand(parsed, messages, seeds, done, profiles, ["en", "fr"], now)
    # English 2 + French 1; the group linked to b counts from b's place; spam goes last
    assert dict(rows(step.visited)) == {"a": 2, "b": 3, "c": 4, "s": 9_999_999}
    assert rows(step.frontier, "channel_id") == [("b",), ("c",), ("s",)]
    assert rows(step.issues, "channel_id", "source_id") == [("a", "gone")]
    assert rows(step.unknown) == [("blank",)]
    issues = str(tmp_path / "issues")
    for _ in range(2):
        record_issues(step.issues, issues)
    more = spark.createDataFrame([("a", "gone"), ("b", "gone")], "channel_id string, source_id string")
    record_issues(more, issues)
    assert rows(spark.read.parquet(issues), "channel_id", "source_id") == [("a", "gone"), ("b", "gone")]
    every = lambda texts: texts.select("id", F.lit("FR").alias("language"))
    hooked = expand(parsed, messages, seeds, done, None, None, now, detector=every)
    assert dict(rows(hooked.visited)) == {"a": 1, "b": 2, "c": 3, "s": 9_999_999}
    fetch = step.fetch.filter("channel_id='a'")
    assert rows(fetch, "period", "offset_id") == [
        ("2024-01-01_to_2024-02-01", 5),
        ("2024-02-01_to_2024-03-01", 0),
    ]


def test_tracking(spark, tmp_path):
    log, arrays = str(tmp_path / "log"), str(tmp_path / "arrays")
    at = lambda h: dt.datetime(2024, 1, 1, h)
    fields = "channel_id string, id long, date timestamp, queried_at timestamp, views long"
    new = spark.createDataFrame([("a", i, at(0), at(1), i) for i in range(3)], fields)
    nothing = new.filter("false")
    track(spark, nothing, new, log, "1")
    pull = new.filter("id < 2").withColumns({"queried_at": F.lit(at(2)), "views": F.col("views") + 10})
    late = spark.createDataFrame([("a", 9, at(1), at(2), 9)], fields)
    path = track(spark, pull, late.unionByName(new.filter("id=0")), log, "2")
    assert path.endswith("version=2") and latest_version(spark, log).endswith("version=2")
    roll_up(spark, log, arrays, 4)
    got = spark.read.schema("channel_id string, id long, views array<long>").json(arrays)
    assert rows(got, "id", "views") == [(0, [0, 10]), (1, [1, 11]), (9, [9])]


def test_admission_goes_on_from_what_was_followed(spark, tmp_path):
    log = str(tmp_path / "log")
    fields = "channel_id string, id long, date timestamp, queried_at timestamp, views long"

    def hour(h, n):
        at = dt.datetime(2024, 1, 1, h)
        return spark.createDataFrame([("a", h * 1000 + i, at, at, 1) for i in range(n)], fields)

    nothing = hour(0, 1).filter("false")
    track(spark, nothing, hour(0, 99), log, "0")
    for h in (1, 2):  # all followed messages vanished: the log is empty, the admissions are not
        track(spark, nothing, hour(h, 60), log, str(h))
    assert admissions(spark, log).count() == 159
    assert spark.read.parquet(latest_version(spark, log)).count() == 0
    assert observation_log(spark, log).count() == 0


def test_rounds_are_appended(spark, tmp_path):
    """An almost full channel, a message that vanishes and comes back, a pull over several
    hours, and a round that is repeated."""
    log = str(tmp_path / "log")
    at = lambda h: dt.datetime(2024, 1, 1, h)
    fields = "channel_id string, id long, date timestamp, queried_at timestamp, views long"
    frame = lambda data: spark.createDataFrame(data, fields)
    track(spark, frame([]), frame([("a", i, at(0), at(1), i) for i in range(99)]), log, "1")
    first = {f: f.stat().st_mtime_ns for f in (tmp_path / "log").rglob("*.parquet")}
    seen = [("a", i, None, at(h), 100 + h) for i in range(98) for h in (2, 3)]  # 98 is gone
    for _ in range(2):
        track(spark, frame(seen), frame([("a", 200 + i, at(2), at(3), 1) for i in range(3)]), log, "2")
    late = [("a", i, None, at(4), 7) for i in (*range(1, 99), 200, 999)]  # 0, 201, 202 are gone, 98 is back
    track(spark, frame(late), frame([("a", 300, at(4), at(4), 1)]), log, "3")
    assert all(f.stat().st_mtime_ns == t for f, t in first.items())
    assert admissions(spark, log).count() == 102
    kept = dict(rows(observation_log(spark, log).groupBy("id").agg(F.array_sort(F.collect_list("queried_at")))))
    assert kept == {**{i: [at(1), at(3), at(4)] for i in range(1, 98)}, 200: [at(3), at(4)]}
    marked = observation_log(spark, log, mark_deleted=True)
    assert rows(marked.filter("deleted").select("id").distinct()) == [(0,), (201,), (202,)]
    assert marked.select("id").distinct().count() == 102


def test_search_round(spark, tmp_path):
    kw = lambda *words: spark.createDataFrame([(w,) for w in words], "keyword string")
    channels = spark.createDataFrame(
        [("x", "un", "Red news", 1), ("y", "ur", "Blue news", 2)],
        "id string, username string, title string, access_hash long",
    )
    replies = spark.createDataFrame([("1 result: @ur",)], "reply string")
    seeds = spark.createDataFrame([("x", 9), ("z", 3)], "channel_id string, access_hash long")
    text = channel_text(F.col("title"), F.lit(None).cast("string"))
    got = search_round(kw("red", "old"), kw("old"), replies, channels, seeds, text)
    assert rows(got.seeds) == [("x", 1), ("y", 2), ("z", 3)]
    assert rows(got.searched) == [("old",), ("red",)]
    index = WordIndex(spark, str(tmp_path / "words"))
    for _ in range(2):  # the second round takes in nothing and finds the same
        asked = search_round(kw("red", "old"), kw("old"), replies, channels, seeds, text, index)
        assert rows(asked.seeds) == rows(got.seeds) and rows(asked.searched) == rows(got.searched)
    write_round(got, str(tmp_path), "1")
    assert spark.read.parquet(latest_version(spark, str(tmp_path / "seeds"))).count() == 3


def test_scans_are_pruned_and_filters_pushed(spark, tmp_path):
    from chanlake.operators.filters import up_to
    from chanlake.operators.periods import high_water_mark

    path = str(tmp_path / "t")
    spark.range(10).selectExpr(
        "id", "'a' channel_id", "timestamp_seconds(id) date", "'long text' message"
    ).write.parquet(path)
    saved = up_to(spark.read.parquet(path), F.to_timestamp(F.lit("1970-01-01 00:00:05")))
    plan = high_water_mark(saved)._jdf.queryExecution().executedPlan().toString()
    assert "message" not in plan.split("ReadSchema")[1]
    assert "LessThanOrEqual(date" in plan


def test_no_query_uses_nested_loops_or_python(spark):
    """Plans of queries that only build one, on the smallest tables."""
    import __spark_entry__ as entry

    lazy = [
        "flatten_messages", "content_counts", "deanonymise", "safe_anonymise", "redact_mentions",
        "preprocess_messages", "anonymise_channel", "flatten_channels", "forwards_from",
        "recommended_by", "last_forward_per_source", "edge_channel_lookup", "forward_sources",
        "search_channels", "comment_thread", "missing_periods", "nth_to_last", "upsert_latest",
        "observation_arrays", "sample_cap", "append_pull", "erase_channel", "after_offset",
    ]
    for name in lazy:
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("NestedLoop", "Cartesian", "EvalPython", "MapInPandas"):
            assert bad not in plan, (name, bad)
