"""Upserts, periods, observations, erasing, search, language, plans and streams."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chanlake.functions.dates import days_since, hour_bins, month_bins
from chanlake.functions.text import clean_text, extract_usernames
from chanlake.operators import locations, observe, periods, search, upsert
from chanlake.operators.erase import erase_from_map, erase_from_table
from chanlake.operators.language import detect_language, train_profiles
from chanlake.operators.search import merge_seeds_last_wins
from chanlake.plans.anon_map import merge_map_files
from chanlake.plans.channel_tables import build_channel_tables
from chanlake.plans.message_tables import MessageTables
from chanlake.session import shared_dir
from chanlake.sources.paths import with_path_params
from chanlake.sources.tables import scan_table, write_bucketed
from chanlake.streaming.messages import stream_messages
from tests.conftest import KEY, rows
from tests.test_messages import LINES
from tests.test_pseudonyms import digest


def messages(spark, *values):
    return spark.createDataFrame(list(values), "channel_id string, id long, text string, seen long")


def dated(spark, *values):
    stamped = [(c, i, d and dt.datetime.fromisoformat(d), text, seen) for c, i, d, text, seen in values]
    return spark.createDataFrame(stamped, "channel_id string, id long, date timestamp, text string, seen long")


DATED = {"channel_id": "string", "id": "bigint", "date": "timestamp", "text": "string", "seen": "bigint"}


def test_a_message_whose_date_moves_leaves_its_old_month(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(*values):
        return upsert.upsert_table(dated(spark, *values), path, DATED, order_by=("seen",), buckets=2)

    def stored():
        columns = ("channel_id", "id", F.col("date_month"), "text")
        return sorted(tuple(r) for r in spark.read.parquet(path).select(*columns).collect())

    def placed():
        return sorted(tuple(r) for r in spark.read.parquet(path + "-keys").select("channel_id", "id", "month").collect())

    put(("c", 1, "2024-01-31", "a", 1), ("c", 2, "2024-01-05", "b", 1), ("d", 1, "2024-03-01", "c", 1))
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "date_month=202403" in f}
    put(("c", 1, "2024-02-01", "moved", 2))
    assert stored() == [("c", 1, 202402, "moved"), ("c", 2, 202401, "b"), ("d", 1, 202403, "c")]
    assert untouched <= set(spark.read.parquet(path).inputFiles())
    put(("c", 1, "2024-01-30", "stale", 1), ("c", 2, None, "undated", 2), ("c", 100_000, "2024-02-02", "far", 1))
    assert stored() == [("c", 1, 202402, "moved"), ("c", 2, 0, "undated"), ("c", 100_000, 202402, "far"), ("d", 1, 202403, "c")]
    assert placed() == [row[:3] for row in stored()]
    assert not [f for f in spark.read.parquet(path).inputFiles() if "date_month=202401" in f]  # emptied
    # a job that was lost after it had entered a place and moved the row, but not emptied the old folder
    locations.Located(dated(spark, ("c", 1, None, "", 0)), path, 2).replace(
        spark.createDataFrame([("c", 1, 202402), ("c", 1, 202405)], "channel_id string, id long, month int"))
    write_bucketed(dated(spark, ("c", 1, "2024-05-01", "left behind", 0)), path, 2)
    put(("c", 1, "2024-06-01", "again", 3))
    assert [row for row in stored() if row[:2] == ("c", 1)] == [("c", 1, 202406, "again")]
    assert placed() == [row[:3] for row in stored()]
    # without the side table it is made from the keys of the table
    locations.drop_index(spark, path)
    put(("d", 1, "2024-04-01", "moved", 2))
    assert placed() == [row[:3] for row in stored()] and len(stored()) == 4
    erase_from_table(spark.read.parquet(path), path, spark.createDataFrame([("c",)], "channel_id string"), 2)
    assert placed() == [("d", 1, 202404)] == [row[:3] for row in stored()]
    erase_from_table(spark.read.parquet(path), path, spark.createDataFrame([("d",)], "channel_id string"), 2)
    assert placed() == [] == stored()
    put(("e", 7, "2024-04-01", "first again", 1))
    assert placed() == [("e", 7, 202404)] == [row[:3] for row in stored()]


def test_upsert_is_idempotent_and_independent_of_order(spark):
    old = messages(spark, ("a", 1, "old", 1), ("a", 2, "old", 1), ("b", 1, "old", 9))
    new = messages(spark, ("a", 1, "new", 2), ("a", 1, "newer", 3), ("c", 1, "x", 1), ("c", 1, "y", 1))
    once = upsert.upsert(old, new, upsert.MESSAGE_KEY, ("seen",))
    got = rows(once)
    assert [r[2] for r in got[:3]] == ["newer", "old", "old"] and len(got) == 4
    again = upsert.upsert(once, new, upsert.MESSAGE_KEY, ("seen",))
    assert rows(again) == got
    shuffled = upsert.upsert(
        old.orderBy(F.desc("id")), new.repartition(5, "text"), upsert.MESSAGE_KEY, ("seen",)
    )
    assert rows(shuffled) == got
    assert len(rows(upsert.upsert(None, new, upsert.MESSAGE_KEY, ("seen",)))) == 2


def test_upsert_table_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = {"channel_id": "string", "id": "bigint", "text": "string", "seen": "bigint"}
    start = messages(spark, *((f"c{i}", 1, "old", 0) for i in range(20)))
    assert upsert.upsert_table(start, path, schema, order_by=("seen",), buckets=8)
    before = {f.split("/")[-2]: f for f in spark.read.parquet(path).inputFiles()}
    upsert.upsert_table(messages(spark, ("c3", 1, "new", 1)), path, schema, order_by=("seen",), buckets=8)
    after = {f.split("/")[-2]: f for f in spark.read.parquet(path).inputFiles()}
    assert sum(before[b] != after[b] for b in before) == 1
    saved = spark.read.parquet(path)
    assert saved.count() == 20 and rows(saved.filter("text='new'"), "channel_id") == [("c3",)]
    with pytest.raises(ValueError, match="rebuild"):
        upsert.upsert_table(start, path, {**schema, "added": "string"}, buckets=8)
    assert scan_table(spark, path, {**schema, "added": "string"}) is None


def test_upsert_table_touches_only_its_months(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = {"channel_id": "string", "id": "bigint", "date": "timestamp", "text": "string"}
    at = [dt.datetime(2024, m, 3) for m in (1, 2, 3)] + [None]
    start = spark.createDataFrame(
        [(f"c{c}", i, day, "old") for c in range(3) for i, day in enumerate(at)], "channel_id string, id long, date timestamp, text string"
    )
    stages_before = set(Path(shared_dir(spark)).iterdir())
    assert upsert.upsert_table(start, path, schema, buckets=2)
    times = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    new = spark.createDataFrame(
        [("c1", 1, at[1], "new", 7), ("c1", 9, at[1], "new", 7)],
        "channel_id string, id long, date timestamp, text string, extra long",
    )
    assert upsert.upsert_table(new, path, schema, buckets=2)
    left = {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    gone, came = times.keys() - left.keys(), left.keys() - times.keys()
    assert all("date_month=202402" in str(f) for f in gone | came) and gone and came
    assert all(left[f] == t for f, t in times.items() if f in left)
    saved = spark.read.parquet(path)
    assert saved.count() == 13 and rows(saved.filter("text='new'"), "channel_id", "id") == [("c1", 1), ("c1", 9)]
    undated = spark.createDataFrame([("c1", 3, None, "newer", None)], new.schema)
    assert upsert.upsert_table(undated, path, schema, buckets=2)
    assert rows(spark.read.parquet(path).filter("date is null and text='newer'"), "channel_id", "id") == [("c1", 3)]
    erase_from_table(spark.read.parquet(path), path, new.select("channel_id"), 2)
    assert {r.channel_id for r in spark.read.parquet(path).collect()} == {"c0", "c2"}
    assert spark.read.parquet(path).count() == 8
    assert set(Path(shared_dir(spark)).iterdir()) == stages_before  # no stage is left
    assert upsert.needs_rebuild(spark, path, {**schema, "more": "string"}) and not upsert.needs_rebuild(spark, path, schema)


def test_erase(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(messages(spark, *((f"c{i}", 1, "x", 0) for i in range(20))), path, 8)
    gone = spark.createDataFrame([("c3",), ("c4",), ("unknown",)], "channel_id string")
    erase_from_table(spark.read.parquet(path), path, gone, 8)
    assert {r.channel_id for r in spark.read.parquet(path).collect()} == {
        f"c{i}" for i in range(20) if i not in (3, 4)
    }
    maps = spark.createDataFrame(
        [("c3", "a", "1"), ("c5", "a", "1"), ("c3", "b", "2")],
        "channel_id string, original string, hash string",
    )
    _, merged = erase_from_map(maps, gone)
    assert rows(merged) == [("a", "1")]


def test_bins(spark):
    t = lambda s: F.to_timestamp(F.lit(s))
    one = spark.range(1)
    got = one.select(month_bins(t("2024-01-15 10:00:00"), t("2024-04-20 00:00:00"))).first()[0]
    assert [(b.start.month, b.end.month) for b in got] == [(1, 2), (2, 3), (3, 4)]
    assert one.select(month_bins(t("2024-05-01"), t("2024-04-20"))).first()[0] == []
    hours = one.select(hour_bins(t("2024-01-01 05:30:00"))).first()[0]
    assert len(hours) == 14 * 24 + 1
    assert hours[0].start == dt.datetime(2024, 1, 1, 4, 30)
    assert one.select(days_since(t("2024-01-02 12:00:00"), t("2024-01-01"))).first()[0] == -2


def test_missing_periods(spark):
    channels = spark.sql("select 'a' channel_id, timestamp'2024-01-15' date union all select 'b', timestamp'2024-03-01'")
    expected = periods.expected_periods(channels, F.to_timestamp(F.lit("2024-04-10")))
    saved = spark.createDataFrame(
        [("a", "2024-01-01_to_2024-02-01", 4), ("a", "2024-02-01_to_2024-03-01", 9)],
        "channel_id string, period string, id long",
    )
    got = periods.resume_offsets(periods.missing_periods(expected, saved), saved)
    assert rows(got, "channel_id", "period", "offset_id") == [
        ("a", "2024-02-01_to_2024-03-01", 9),
        ("a", "2024-03-01_to_2024-04-01", 0),
        ("b", "2024-03-01_to_2024-04-01", 0),
    ]


def test_nth_to_last(spark):
    df = spark.createDataFrame([("a", "p", i) for i in range(5)] + [("b", "p", 7)], "channel_id string, period string, id long")
    assert rows(periods.nth_to_last(df, 1), "id") == [(4,), (7,)]
    assert rows(periods.nth_to_last(df, 3), "id") == [(2,), (7,)]
    assert rows(periods.nth_to_last(df, 9), "id") == [(0,), (7,)]


def test_sample_cap_admits_whole_hours(spark):
    base = dt.datetime(2024, 1, 1)
    data = [("a", h * 1000 + i, base + dt.timedelta(hours=h)) for h, n in ((0, 60), (1, 60), (2, 5)) for i in range(n)]
    data += [("b", i, base) for i in range(150)]
    df = spark.createDataFrame(data, "channel_id string, id long, date timestamp")
    got = observe.sample_cap(df)
    assert dict(rows(got.groupBy("channel_id").count())) == {"a": 120, "b": 150}


def test_observation_arrays(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    saved = spark.createDataFrame(
        [
            ("a", 1, at(2), 5, None, None, {"x": 1}, None),
            ("a", 1, at(1), None, 3, None, None, 2),
            ("a", 2, at(1), 1, 1, None, None, 0),
        ],
        "channel_id string, id long, queried_at timestamp, views long, forwards long, "
        "edit_date timestamp, reactions map<string,long>, replies long",
    )
    first = observe.observation_arrays(saved).filter("id=1").first()
    assert first.views == [None, 5] and first.forwards == [3, None]
    assert first.replies == [2, 0] and first.reactions == [None, {"x": 1}]
    later = saved.filter("views=5").withColumn("queried_at", F.lit(dt.datetime(2024, 2, 1)))
    months = observe.observation_arrays(saved.unionByName(later)).filter("id=1").orderBy("page").collect()
    assert [(r.page, r.views) for r in months] == [("2024-01", [None, 5]), ("2024-02", [5])]
    pull = saved.filter("id=1 and views=5").withColumn("queried_at", F.lit(at(3)))
    assert rows(observe.append_pull(saved, pull), "id", "queried_at") == [(1, at(1)), (1, at(2)), (1, at(3))]
    marked = observe.latest_vs_saved(saved, pull, mark_deleted=True)
    assert rows(marked.filter("deleted"), "id") == [(2,)]


def test_search(spark):
    channels = spark.createDataFrame([(i, f"Red-widget no {i}") for i in range(150)] + [(200, "infrared widget")], "id long, text string")
    keywords = spark.createDataFrame([("red WIDGET",), ("infrared",), ("none",)], "keyword string")
    got = search.search_channels(channels, keywords, F.col("text"))
    assert dict(rows(got.groupBy("keyword").count())) == {"red WIDGET": 150, "infrared": 1}
    first = search.search_channels(channels, keywords, F.col("text"), 100)
    assert dict(rows(first.groupBy("keyword").count())) == {"red WIDGET": 100, "infrared": 1}
    seeds = [spark.createDataFrame([("a", v)], "channel_id string, access_hash long") for v in (1, 3, 2)]
    assert rows(merge_seeds_last_wins(*seeds)) == [("a", 2)]


def test_texts(spark):
    samples = {
        "hi @bob #tag a@b x": "hi   a@b x",
        "@été fin": " fin",
        "é@b c": "é@b c",
        "see https://a.b/c?d www.x.y t.me/z ok": "see    ok",
    }
    for text, expected in samples.items():
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(clean_text(F.col("t"))).first()[0] == expected
    df = spark.createDataFrame([("1 result: @a_b, @C9!",), ("@a",)], "t string")
    assert [r[0] for r in df.select(extract_usernames(F.col("t"))).collect()] == [["a_b", "C9"], None]


def test_language(spark):
    texts = [
        ("en", "the quick brown fox jumps over the lazy dog and then the other thing that was there"),
        ("fr", "le renard brun saute par dessus le chien paresseux et puis les autres choses qui étaient là"),
    ]
    labelled = spark.createDataFrame([(lang, t) for lang, t in texts for _ in range(3)], "language string, text string")
    probe = spark.createDataFrame(
        [(1, "the other dog was there"), (2, "les autres chiens étaient là"), (3, "12 !"), (4, "zzzz qqqq")],
        "id long, text string",
    )
    got = detect_language(probe, train_profiles(labelled), ["en", "fr"], ["id"])
    assert rows(got, "id", "language") == [(1, "EN"), (2, "FR"), (3, None), (4, None)]


def test_path_templates(spark):
    template = "chan={chan}_month={month}"
    df = spark.createDataFrame([("s3://r/d/chan=a.b_month=2.json",), ("s3://r/d/other.json",)], "file_path string")
    assert rows(with_path_params(df, template + ".json"), "chan", "month") == [("a.b", "2")]
    assert rows(with_path_params(df, template + ".json", chan="zz")) == []


def test_channel_tables(spark, tmp_path):
    docs, table, users = (tmp_path / n for n in ("docs", "channels", "users"))
    docs.mkdir()

    def write(name, **extra):
        doc = {
            "chats": [{"id": name, "title": "T", "username": None, "date": "2024-01-01T00:00:00+00:00", "participants_count": 4}],
            "full_chat": {"id": name, "pts": 3, "participants_count": None, "bot_info": []},
            "participants": [{"id": name + "u", "first_name": "gone", "bot": True}],
            **extra,
        }
        (docs / f"{name}.json").write_text(json.dumps(doc))

    write("a", last_queried_at="2024-02-01T00:00:00+00:00")
    write("b", participants=[])
    first = build_channel_tables(spark, str(docs), str(table), str(users), "1", 4)
    got = {r.id: r for r in spark.read.parquet(first).collect()}
    assert got["a"].last_queried_at == dt.datetime(2024, 2, 1) and got["b"].last_queried_at is not None
    assert got["a"].participants_count is None  # a null in the full half wins
    assert rows(spark.read.parquet(str(users)), "channel_id", "id", "bot") == [("a", "au", True)]
    assert build_channel_tables(spark, str(docs), str(table), str(users), "2", 4) is None
    import os
    import time

    write("a", message_count=9, last_queried_at="2024-03-01T00:00:00+00:00")
    os.utime(docs / "a.json", (time.time() + 5,) * 2)
    second = build_channel_tables(spark, str(docs), str(table), str(users), "2", 4)
    assert rows(spark.read.parquet(second), "id", "message_count") == [("a", 9), ("b", None)]
    # a new channel and a stale copy of a known one arrive late with old times, one file is broken
    write("c")
    (docs / "more").mkdir()
    (docs / "more" / "a.json").write_text((docs / "b.json").read_text().replace('"b"', '"a"'))
    (docs / "bad.json").write_text("{")
    for name in ("c.json", "more/a.json", "bad.json"):
        os.utime(docs / name, (1000, 1000))
    third = build_channel_tables(spark, str(docs), str(table), str(users), "3", 4)
    assert rows(spark.read.parquet(third), "id", "message_count") == [("a", 9), ("b", None), ("c", None)]
    assert spark.read.parquet(f"{table}-quarantine").count() == 1
    assert build_channel_tables(spark, str(docs), str(table), str(users), "4", 4) is None


def test_map_files(spark, tmp_path):
    maps = tmp_path / "maps"
    maps.mkdir()
    (maps / "c1.json").write_text(json.dumps({"a": digest("a"), "b": digest("b")}))
    (maps / "c2.json").write_text(json.dumps({"a": digest("a"), "x": "wrong"}))
    report = merge_map_files(spark, str(maps), str(tmp_path / "out"), "1", KEY)
    assert report.duplicated_rows == 0 and rows(report.mismatches, "original") == [("x",)]
    assert spark.read.parquet(report.path).count() == 3
    again = merge_map_files(spark, str(maps), str(tmp_path / "out"), "2", KEY)
    assert spark.read.parquet(again.path).count() == 3


def test_stream_equals_batch_and_survives_restarts(spark, tmp_path):
    raw, checkpoint = tmp_path / "raw" / "c1", str(tmp_path / "checkpoint")
    raw.mkdir(parents=True)
    out = tmp_path / "out"
    tables = MessageTables(str(out / "m"), str(out / "s"), str(out / "q"))

    def run():
        stream_messages(spark, str(tmp_path / "raw"), tables, checkpoint, 4).awaitTermination()
        return spark.read.parquet(tables.messages)

    (raw / "2024-01-01_to_2024-02-01.jsonl").write_text("\n".join(LINES))
    assert run().count() == 9
    (raw / "2024-02-01_to_2024-03-01.jsonl").write_text(
        LINES[0].replace("plain", "edited") + "\n" + LINES[0].replace('"id":1', '"id":50')
    )
    table = run()
    assert table.count() == 10 and table.filter("id=50").count() == 1
    assert run().count() == 10
