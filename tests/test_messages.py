"""Reading, repairing, decoding and flattening message logs."""

from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from chanlake.operators.filters import (
    content_only,
    forwarded_from_channel,
    service_side,
    with_comment_thread,
)
from chanlake.operators.flatten import content_counts, flatten_messages, flatten_service
from chanlake.plans.message_tables import (
    MessageTables,
    build_message_tables,
    with_channel_and_period,
)
from chanlake.schemas import MESSAGES
from chanlake.sources.messages import (
    decode_messages,
    quarantined,
    scan_forward_view,
    scan_messages,
    valid,
)
from tests.conftest import rows

LINES = [
    '{"_":"Message","id":1,"date":"2024-01-02T03:04:05+00:00","message":"plain"}',
    '{"_":"Message","id":2,"date":"2024-01-02T03:05:00+00:00","message":"v","media":{"_":"MessageMediaDocument","document":{"id":7},"video":true,"voice":true},"from_id":{"_":"PeerUser","user_id":"ab"},"replies":{"replies":3,"comments":true}}',
    '{"_":"Message","id":3,"date":null,"message":"w","media":{"_":"MessageMediaWebPage","webpage":{"id":9,"url":"https://x.example"}},"fwd_from":{"date":"2024-01-01T00:00:00+00:00","from_id":{"_":"PeerChannel","channel_id":"cd"},"channel_post":5},"reply_to":{"reply_to_msg_id":1}}',
    '{"_":"Message","id":4,"date":"2024-01-03T00:00:00+00:00","message":"r","media":{"_":"MessageMediaPoll"},"reactions":{"results":[{"count":2,"reaction":{"emoticon":"A"}},{"count":1,"reaction":{"document_id":55}},{"count":4,"reaction":{"emoticon":"A"}},{"count":9,"reaction":{"emoticon":""}}]}}',
    '{"_":"Message","id":5,"date":"2024-01-03T00:00:00+00:00","message":"old comment","comments_msg_id":1}',
    '{"_":"MessageService","id":6,"date":"2024-01-03T00:00:00+00:00","action":{"_":"MessageActionChatAddUser","users":[1,2]}}',
    "",
    '{"_":"Message","id":7,"date":null,"message":"a}{b}{"}{"_":"Message","id":8,"date":null,"message":"glued","extra":{"x":1}}',
    '{"_":"Message","id":9,"date":null,"message":"p","media":{"_":"MessageMediaPhoto","photo":{"id":1}},"reactions":{}}',
    '{"_":"Message","id":10,"date":null,"message":"vo","media":{"_":"MessageMediaDocument","document":{"id":2},"voice":true},"replies":{"replies":0}}',
    '{"_":"Message","id":11,"date":null,"message":"d","media":{"_":"MessageMediaDocument","document":{"id":3}},"reactions":null}',
]
BAD = [
    '{"_":"Message","id":20,"date":null}',
    '{"_":"Message","id":"21","date":null,"message":"x"}',
    '{"_":"Sticker","id":22,"date":null,"message":"x"}',
    '{"_":"Message","id":23,"message":"no date key"}',
    '{"_":"Message","id":24,"date":null,"message":"x","media":{"_":"MessageMediaNew"}}',
    '{"_":"Message","id":25,"date":null,"message":"x","from_id":{"_":"PeerOther"}}',
    '{"_":"Message","id":26,"date":null,"message":"x"} trailing',
    '{"_":"Message","id":27,"date":null,"mess',
    '{"_":"Message","id":28,"date":null,"message":"x","fwd_from":{"channel_post":1}}',
    '{"_":"Message","id":29,"date":null,"message":"x","replies":{"comments":true}}',
    '{"_":"MessageService","id":30,"date":null}',
]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "messages" / "chan1"
    folder.mkdir(parents=True)
    (folder / "2024-01-01_to_2024-02-01.jsonl").write_text("\n".join(LINES + BAD) + "\n")
    other = tmp_path / "messages" / "chan2"
    other.mkdir()
    with gzip.open(other / "2024-02-01_to_2024-03-01.jsonl.gz", "wt") as f:
        f.write(LINES[0] + "\n" + LINES[0].replace("plain", "newer") + "\n")
    (other / "notes.txt").write_text("ignored")
    return str(tmp_path / "messages")


def test_scan_keeps_good_lines_and_quarantines_bad_ones(spark, raw):
    decoded = with_channel_and_period(decode_messages(spark, raw))
    good = valid(decoded)
    assert rows(good.filter("channel_id='chan1'"), "id") == rows(
        spark.createDataFrame([(i,) for i in range(1, 12)], "id long")
    )
    assert good.filter("channel_id='chan2' and period='2024-02-01_to_2024-03-01'").count() == 2
    assert good.filter("id=7").first().message == "a}{b}{"
    bad = quarantined(decoded)
    reasons = {
        (json.loads(r.value).get("id") if r.value.endswith("}") else None): r.decode_error
        for r in bad.collect()
    }
    assert bad.count() == len(BAD)
    assert reasons[20] == "message missing"
    assert reasons["21"] == "not a record of this shape"
    assert reasons[22] == "unknown tag"
    assert reasons[23] == "date missing"
    assert reasons[24] == "unknown media tag"
    assert reasons[25] == "unknown peer tag"
    assert reasons[28] == "forward date missing"
    assert reasons[29] == "reply count missing"
    assert reasons[30] == "action missing"


def test_flatten(spark, raw):
    good = with_channel_and_period(scan_messages(spark, raw)).filter("channel_id='chan1'")
    flat = flatten_messages(content_only(good), keep=("channel_id",))
    assert flat.columns == ["channel_id", *MESSAGES]
    got = {r.id: r for r in flat.collect()}
    assert set(got) == {1, 2, 3, 4, 7, 8, 9, 10, 11}
    assert (got[1].nr_replies, got[1].has_comments, got[1].media_type) == (0, False, None)
    assert got[1].date == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert (got[2].media_type, got[2].media_id) == ("video", 7)
    assert (got[2].from_type, got[2].from_id) == ("PeerUser", "ab")
    assert (got[2].nr_replies, got[2].has_comments) == (3, True)
    assert (got[3].media_type, got[3].media_id) == ("webpage", 9)
    assert got[3].webpage_preview_url == "https://x.example"
    assert (got[3].fwd_from_type, got[3].fwd_from_id, got[3].fwd_from_msg_id) == (
        "PeerChannel",
        "cd",
        5,
    )
    assert (got[3].replies_to_msg_id, got[3].replies_to_chan_id) == (1, None)
    assert (got[4].media_type, got[4].media_id) == ("other", None)
    assert got[4].reactions == {"A": 4, "55": 1, "None": 9}
    assert got[9].reactions == {} and got[11].reactions is None
    assert [got[i].media_type for i in (9, 10, 11)] == ["photo", "voice", "document"]
    assert (got[10].nr_replies, got[10].has_comments) == (0, None)

    side = service_side(good)
    assert rows(side, "id") == [(5,), (6,)]
    service = flatten_service(side.filter("id=6")).first()
    assert service.action_type == "MessageActionChatAddUser"
    assert json.loads(service.action) == {"users": [1, 2]}
    assert rows(with_comment_thread(flat), "id") == [(2,)]
    assert rows(forwarded_from_channel(good), "id") == [(3,)]
    counts = content_counts(flat).first()
    assert (counts.message_count, counts.video_count, counts.voice_count) == (9, 1, 1)
    assert (counts.photo_count, counts.url_count, counts.gif_count) == (1, 1, None)


def test_forward_view(spark, raw, tmp_path):
    assert scan_forward_view(spark, str(tmp_path / "nothing")).count() == 0
    view = scan_forward_view(spark, raw + "/chan1")
    assert view.filter("fwd_from is not null").first().id == 3
    # any tag is accepted here
    assert 22 in {r.id for r in view.collect()}
    one = scan_forward_view(spark, raw + "/chan1/2024-01-01_to_2024-02-01.jsonl")
    assert one.count() == view.count()


def test_build_tables_incrementally(spark, raw, tmp_path):
    out = tmp_path / "out"
    tables = MessageTables(str(out / "messages"), str(out / "service"), str(out / "bad"))
    assert build_message_tables(spark, raw, tables, buckets=4)
    messages = spark.read.parquet(tables.messages)
    assert messages.count() == 9 + 1
    assert rows(spark.read.parquet(tables.service), "id") == [(5,), (6,)]
    assert spark.read.parquet(tables.quarantine).count() == len(BAD)
    # nothing new
    assert not build_message_tables(spark, raw, tables, buckets=4)
    # a newer file replaces message 1 and adds one
    import os
    import time

    path = f"{raw}/chan1/2024-02-01_to_2024-03-01.jsonl"
    with open(path, "w") as f:
        f.write(LINES[0].replace("plain", "edited") + "\n")
        f.write(LINES[0].replace('"id":1', '"id":99') + "\n")
    later = time.time() + 5
    os.utime(path, (later, later))
    assert build_message_tables(spark, raw, tables, buckets=4)
    messages = spark.read.parquet(tables.messages)
    assert messages.count() == 11
    assert messages.filter("channel_id='chan1' and id=1").first().message == "edited"
    assert messages.filter(F.col("id") == 99).count() == 1


def _log(path, *lines, at):
    import os

    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (at, at))


def test_one_run_and_many_runs_give_the_same_tables(spark, tmp_path):
    bad = '{"_":"Message","id":20,"date":null}'
    edited = LINES[0].replace("plain", "edited")
    logs = [  # name, time, lines: later ones arrive later, with older and equal times
        ("c1/2024-01-01_to_2024-02-01.jsonl", 2000, (edited, bad)),
        ("c1/2023-12-01_to_2024-01-01.jsonl", 1000, (LINES[0], LINES[4])),
        ("c[2]/2024-01-01_to_2024-02-01.jsonl", 2000, (LINES[0], bad)),
        ("c3/2024-01-01_to_2024-02-01.jsonl", 1500, (LINES[1],)),
    ]
    fields = ("channel_id", "id", "message", "comments_msg_id")
    got = {}
    for runs in ("many", "one"):
        raw, out = tmp_path / runs / "raw", tmp_path / runs / "out"
        tables = MessageTables(str(out / "m"), str(out / "s"), str(out / "q"))
        for name, at, lines in logs:
            _log(raw / name, *lines, at=at)
            if runs == "many":
                assert build_message_tables(spark, str(raw), tables, buckets=4)
        assert build_message_tables(spark, str(raw), tables, buckets=4) == (runs == "one")
        got[runs] = [rows(spark.read.parquet(p), *fields) for p in (tables.messages, tables.service)]
        got[runs].append(spark.read.parquet(tables.quarantine).count())
    assert got["many"] == got["one"]
    messages, service, quarantined_lines = got["one"]
    assert [r[:3] for r in messages] == [("c1", 1, "edited"), ("c3", 2, "v"), ("c[2]", 1, "plain")]
    assert service == [("c1", 5, "old comment", 1)] and quarantined_lines == 2


def test_a_rewritten_file_is_read_again_and_stages_are_removed(spark, tmp_path):
    import os

    raw, out = tmp_path / "raw", tmp_path / "out"
    tables = MessageTables(str(out / "m"), str(out / "s"), str(out / "q"))
    name = raw / "c1" / "2024-01-01_to_2024-02-01.jsonl"
    _log(name, LINES[0], at=2000)
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    assert build_message_tables(spark, str(raw), tables, buckets=4)
    assert spark.read.parquet(tables.service).count() == 0  # no service rows: an empty table
    assert not build_message_tables(spark, str(raw), tables, buckets=4)
    _log(name, LINES[0].replace("plain", "longer text"), at=2000)  # same time, another length
    assert build_message_tables(spark, str(raw), tables, buckets=4)
    assert rows(spark.read.parquet(tables.messages), "message") == [("longer text",)]
    assert set(os.listdir(shared)) == before
