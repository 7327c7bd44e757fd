"""Keyed hashing, redaction and nested anonymisation."""

from __future__ import annotations

import hmac
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chanlake.functions.pseudonym import hashed, keyed, unkeyed
from chanlake.functions.redact import extract_mentions, extract_urls, redact_entities
from chanlake.operators import anonymise as A
from chanlake.operators import pseudonyms as P
from chanlake.schemas import CHANNEL_DOC, PRIVATE_MESSAGE, ddl
from chanlake.sources.messages import scan_private_messages
from tests.conftest import KEY, rows


def digest(value):
    return hmac.new(bytes.fromhex(KEY), str(value).encode(), "sha256").hexdigest()


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=1, max_size=30))
def test_hash_equals_hmac(spark, values):
    df = P.with_hashes(spark.createDataFrame([(v,) for v in values], "v string"), {"h": "v"}, KEY)
    assert [(r.v, r.h) for r in df.collect()] == [(v, digest(v)) for v in values]


def test_long_key_numbers_and_null(spark):
    key = "ab" * 80
    df = spark.createDataFrame([(5, "5"), (None, None)], "n long, s string")
    got = P.with_hashes(df, {"a": "n", "b": "s"}, key).collect()
    expected = hmac.new(bytes.fromhex(key), b"5", "sha256").hexdigest()
    assert (got[0].a, got[0].b) == (expected, expected)
    assert (got[1].a, got[1].b) == (None, None)


def test_key_is_not_in_any_plan(spark):
    df = P.with_hashes(spark.range(3), {"h": "id"}, KEY)
    df.collect()
    shown = df._jdf.queryExecution().toString() + df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")
    )
    block = bytes.fromhex(KEY).ljust(64, b"\0")
    for pad in (0x36, 0x5C):
        raw = bytes(b ^ pad for b in block)
        assert raw.hex() not in shown.lower()
        assert raw.hex()[:16] not in shown.lower()
        assert " ".join(f"{b:02x}" for b in raw[:6]) not in shown.lower()
        assert str(list(raw[:6]))[1:-1] not in shown


def utf16(text):
    return len(text.encode("utf-16-le")) // 2


def entity(kind, text, part, url=None):
    at = text.index(part)
    return (f"MessageEntity{kind}", utf16(text[:at]), utf16(part), url)


@pytest.fixture
def redact(spark):
    def run(text, entities):
        df = spark.createDataFrame(
            [(text, entities)],
            "message string, entities array<struct<_:string,offset:int,length:int,url:string>>",
        )
        m, e = F.col("message"), F.col("entities")
        return (
            keyed(df, KEY)
            .select(
                redact_entities(m, e).alias("text"),
                extract_mentions(m, e).alias("mentions"),
                extract_urls(m, e).alias("urls"),
            )
            .first()
        )

    return run


def test_redaction(redact):
    text = "😀 hi @bob, mail ann@x.example or Ünal 𝄞 see http://a.example/b end"
    got = redact(
        text,
        [
            entity("Mention", text, "@bob"),
            entity("Email", text, "ann@x.example"),
            entity("MentionName", text, "Ünal 𝄞"),
            entity("Url", text, "http://a.example/b"),
            entity("TextUrl", text, "see", "http://t.example"),
            entity("Bold", text, "hi"),
        ],
    )
    assert got.text == (
        f"😀 hi @{digest('bob')}, mail {digest('ann')}@{digest('x.example')} or "
        f"{digest('Ünal 𝄞')} see http://a.example/b end"
    )
    assert got.mentions == sorted([digest("bob"), digest("Ünal 𝄞")])
    assert got.urls == ["http://a.example/b", "http://t.example"]


def test_redaction_without_personal_entities_is_identity(redact):
    assert redact("nothing 😀 here", []).text == "nothing 😀 here"
    assert redact("nothing 😀 here", None).text == "nothing 😀 here"
    assert redact("a b", [("MessageEntityBold", 0, 1, None)]).text == "a b"
    assert redact("a b", None).mentions == []


def test_overlapping_spans_and_bounds(redact):
    got = redact("@abcdef", [("MessageEntityMention", 0, 5, None), ("MessageEntityMention", 2, 5, None)])
    assert got.text == f"@{digest('abcd')}{digest('cdef')}"
    # a span over the end is cut, one inside a surrogate pair moves outwards
    assert redact("@ab", [("MessageEntityMention", 0, 99, None)]).text == f"@{digest('ab')}"
    assert redact("x😀y", [("MessageEntityMentionName", 2, 1, None)]).text == f"x{digest('😀')}y"


MESSAGE = {
    "_": "Message",
    "id": 1,
    "date": None,
    "message": "yo @bob",
    "peer_id": {"_": "PeerChannel", "channel_id": 11},
    "from_id": {"_": "PeerUser", "user_id": 12},
    "post_author": "Ann",
    "replies": {
        "replies": 1,
        "channel_id": 13,
        "recent_repliers": [{"_": "PeerUser", "user_id": 14}, {"_": "PeerChannel", "channel_id": 15}],
    },
    "reply_to": {"reply_to_msg_id": 3, "reply_to_peer_id": {"_": "PeerChat", "chat_id": 16}},
    "fwd_from": {
        "date": None,
        "from_id": {"_": "PeerChannel", "channel_id": 17},
        "saved_from_peer": {"_": "PeerUser", "user_id": 18},
        "from_name": "Carl",
        "post_author": None,
    },
    "entities": [{"_": "MessageEntityMention", "offset": 3, "length": 4}],
}
ACTIONS = {
    "MessageActionChatAddUser": ({"users": [1, 2]}, {"users": [digest(1), digest(2)]}),
    "MessageActionChatCreate": (
        {"users": [3], "title": "T"},
        {"users": [digest(3)], "title": digest("T")},
    ),
    "MessageActionChatDeleteUser": ({"user_id": 4}, {"user_id": digest(4)}),
    "MessageActionChatJoinedByLink": ({"inviter_id": 5}, {"inviter_id": digest(5)}),
    "MessageActionChatEditPhoto": (
        {"photo": {"id": 6, "sizes": [1]}},
        {"photo": {"id": digest(6), "sizes": [1]}},
    ),
    "MessageActionChatMigrateTo": ({"channel_id": 7}, {"channel_id": digest(7)}),
    "MessageActionChannelMigrateFrom": (
        {"title": "U", "chat_id": 8},
        {"title": digest("U"), "chat_id": digest(8)},
    ),
    "MessageActionChannelCreate": ({"title": "V"}, {"title": digest("V")}),
    "MessageActionChatEditTitle": ({"title": "W"}, {"title": digest("W")}),
    "MessageActionPinMessage": ({"title": "kept", "user_id": 9}, {"title": "kept", "user_id": 9}),
    "MessageActionGeoProximityReached": (
        {"peer": {"_": "PeerUser", "user_id": 10}, "peer_id": {"_": "PeerChat", "chat_id": 9}},
        {
            "peer": {"_": "PeerUser", "user_id": digest(10)},
            "peer_id": {"_": "PeerChat", "chat_id": digest(9)},
        },
    ),
}


@pytest.fixture
def private(spark, tmp_path):
    folder = tmp_path / "c1"
    folder.mkdir()
    lines = [MESSAGE] + [
        {"_": "MessageService", "id": 100 + i, "date": None, "action": {"_": kind, **before}}
        for i, (kind, (before, _)) in enumerate(ACTIONS.items())
    ]
    (folder / "2024-01-01_to_2024-02-01.jsonl").write_text("\n".join(map(json.dumps, lines)))
    return scan_private_messages(spark, str(tmp_path))


def test_preprocess_messages(private):
    got = A.preprocess_messages(private, KEY)
    assert "entities" not in got.columns
    m = got.filter("id=1").first()
    assert m.message == f"yo @{digest('bob')}"
    assert m.text_mentions == [digest("bob")] and m.text_urls == []
    assert m.peer_id.channel_id == digest(11) and m.from_id.user_id == digest(12)
    assert m.post_author == digest("Ann")
    assert m.replies.channel_id == digest(13)
    assert [r.user_id or r.channel_id for r in m.replies.recent_repliers] == [digest(14), digest(15)]
    assert m.reply_to.reply_to_peer_id.chat_id == digest(16)
    assert m.fwd_from.from_id.channel_id == digest(17)
    assert m.fwd_from.saved_from_peer.user_id == digest(18)
    assert (m.fwd_from.from_name, m.fwd_from.post_author) == (digest("Carl"), None)
    for r in got.filter("id>=100").collect():
        action = json.loads(r.action)
        assert action == {"_": action["_"], **ACTIONS[action["_"]][1]}


def test_every_hash_is_in_the_collected_map(private):
    found = P.pseudonym_map(A.collect_identities(private), KEY)
    expected = {"bob", "Ann", "Carl", "T", "U", "V", "W"} | {str(i) for i in range(1, 9)}
    expected |= {str(i) for i in range(9, 19)}
    assert {(r.original, r.hash) for r in found.collect()} == {(v, digest(v)) for v in expected}
    assert A.forward_origins(private).first().forwarded_id == "17"


def test_map_checks(spark):
    good = [("a", digest("a")), ("b", digest("b"))]
    df = spark.createDataFrame(good + [("c", digest("b")), (None, "x"), ("d", None)], "original string, hash string")
    assert rows(P.verify_pseudonyms(df, KEY), "original") == [("c",), ("d",)]
    assert P.duplicate_hashes(df).first().rows == 2
    data = spark.createDataFrame([(1, digest("a")), (2, "zz"), (3, None)], "n long, v string")
    got = P.deanonymise(data, df, "v")
    assert rows(got, "n", "v") == [(1, "a"), (2, "zz"), (3, None)]
    assert rows(P.unmapped(data, df, "v")) == [("zz",)]


def test_safe_anonymise_twice_is_once(spark):
    data = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n long, v string")
    once = P.with_hashes(data, {"v": "v"}, KEY)
    known = P.pseudonym_map(P.originals(data, [F.col("v")]), KEY)
    twice = P.safe_anonymise(once, known, "v", KEY)
    assert rows(twice, "n", "v") == rows(once, "n", "v")
    assert rows(P.safe_anonymise(data, known, "v", KEY), "n", "v") == rows(once, "n", "v")


def test_merge_maps(spark):
    maps = spark.sql(
        "select * from values ('a','1',timestamp'2024-01-01','p1'),('a','2',timestamp'2024-01-02','p0'),"
        "('b','3',timestamp'2024-01-01','p1'),('b','4',timestamp'2024-01-01','p2') "
        "t(original,hash,file_modified,file_path)"
    )
    merged = P.merge_maps_last_wins(maps)
    assert rows(merged, "original", "hash") == [("a", "2"), ("b", "4")]
    assert P.merge_anon_maps(merged, merged).count() == 2


def test_anonymise_channels(spark):
    doc = {
        "chats": [
            {"id": 1, "username": "u", "title": "T", "photo": "p", "usernames": [{"username": "v", "active": True}]},
            {"id": 2, "username": None, "title": "G", "usernames": None, "migrated_to": {"channel_id": 9}},
        ],
        "full_chat": {"id": 1, "about": "x", "linked_chat_id": 2, "chat_photo": "q"},
        "recommended_channels": [5],
        "users": [{"id": 7, "first_name": "F", "phone": "1", "bot": False}],
    }
    df = spark.createDataFrame([(json.dumps(doc),)], "v string").select(
        F.from_json("v", ddl(CHANNEL_DOC)).alias("d")
    ).select("d.*")
    ids = {r.original for r in P.originals(df, A.channel_identities()).collect()}
    assert ids == {"1", "2", "u", "v", "T", "G", "9", "5", "7"}
    once = A.anonymise_channels(df, KEY)
    got = once.first()
    assert [c.id for c in got.chats] == [digest(1), digest(2)]
    assert got.chats[0].usernames[0].username == digest("v") and got.chats[0].photo is None
    assert got.chats[1].usernames is None and got.chats[1].migrated_to.channel_id == digest(9)
    assert got.chats[0].migrated_to is None
    assert (got.full_chat.id, got.full_chat.linked_chat_id) == (digest(1), digest(2))
    assert got.full_chat.migrated_from_chat_id is None and got.full_chat.chat_photo is None
    assert got.recommended_channels == [digest(5)]
    assert (got.users[0].id, got.users[0].first_name, got.users[0].bot) == (digest(7), None, False)
    assert got.participants is None
    again = A.anonymise_channels(once, KEY).first()
    assert again.chats == got.chats and again.full_chat == got.full_chat
    # With a map, what only looks like a pseudonym is hashed; what the map knows stays.
    known = P.collect_pseudonym_map(df, A.channel_identities(), KEY).filter("original <> 'T'")
    third = A.anonymise_channels(once.unionByName(df), KEY, anon_map=known).collect()
    for row in third:
        twice = row.chats[0].title == digest(digest("T"))
        assert row.chats[0].title == digest(digest("T") if twice else "T")
        assert [c.id for c in row.chats] == [digest(1), digest(2)] and row.full_chat == got.full_chat
        assert row.chats[0].usernames[0].username == digest("v") and row.chats[1].title == digest("G")
    assert len({row.chats[0].title for row in third}) == 2 and "_known" not in third[0]


def test_message_schema_reads_ids_as_text():
    assert "user_id:string" in PRIVATE_MESSAGE["from_id"]


def test_keyed_columns_do_not_remain(spark):
    df = keyed(spark.range(1), KEY)
    assert unkeyed(df.select("*", hashed(F.col("id")).alias("h"))).columns == ["id", "h"]
