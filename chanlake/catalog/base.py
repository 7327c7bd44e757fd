"""Inputs of the named queries: message and channel documents derived from the tables.

The tables hold no messages, so they are read as such: an event is a message of the
channel that its user stands for, and so on. ``EVENTS_SQL`` says the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.functions.pseudonym import key_blocks
from chanlake.schemas import RAW_MESSAGE, Schema
from chanlake.session import configure
from chanlake.sources.messages import decode, valid
from chanlake.sources.paths import stored_bytes

Query = Callable[[SparkSession, str], DataFrame]
Entry = tuple[Query, str | None]

# Key of the queries (a public test value; jobs take theirs from the caller).
KEY = bytes(range(32)).hex()
SPREAD_BYTES = 4 << 20  # of Parquet: some 200,000 events


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; its zone-less timestamps are read as UTC.

    With ``spread`` a table is dealt to all cores, and to a task for each ``SPREAD_BYTES`` at least,
    for work that costs more per row than moving the row: what a task holds does not grow with the
    table. A table in as many files is left alone.
    """
    configure(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread:
        files = len(df.inputFiles())
        parts = max(spark.sparkContext.defaultParallelism, -(-stored_bytes(spark, f"{sf_dir}/{name}.parquet") // SPREAD_BYTES))
        if files < parts:
            df = df.repartition(parts)
    moments = {
        c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"
    }
    return df.withColumns(moments) if moments else df


def when_text(ts: str | Column) -> Column:
    """Timestamps leave the queries as text, alike in every engine."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def when_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def list_text(values: str | Column) -> Column:
    return F.array_join(values, "|")


def hmac_sql(value: str, key: str = KEY) -> str:
    """HMAC-SHA-256 of a text expression in SQL."""
    inner, outer = (
        "'" + "".join(f"\\x{b:02X}" for b in block) + "'::BLOB" for block in key_blocks(key)
    )
    return f"sha256({outer} || unhex(sha256({inner} || encode(CAST({value} AS VARCHAR)))))"


# --- events as messages --------------------------------------------------------------


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def _text(prefix: str, value: str | Column) -> Column:
    return F.concat(F.lit(prefix), F.col(value) if isinstance(value, str) else value)


def _peer(tag: str, field: str, value: Column) -> Column:
    fields = ("channel_id", "user_id", "chat_id")
    return F.struct(
        F.lit(tag).alias("_"),
        *((value if f == field else F.lit(None).cast("string")).alias(f) for f in fields),
    )


def events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in their properties as ``k``."""
    return table(spark, sf_dir, "events", spread=True).withColumn(
        "k", F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
    )


EVENTS_SQL = (
    "ev AS (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k, "
    "'c' || user_id AS channel_id FROM events)"
)


def message_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested message records, besides ``channel_id, period, ts, k``."""
    k = F.col("k")
    content = F.col("event_type") != "error"
    kind = F.col("event_type")
    none = F.lit(None).cast("string")

    def media_struct(tag: str, photo=None, document=None, video=None, voice=None, page=None):
        return F.struct(
            F.lit(f"MessageMedia{tag}").alias("_"),
            (photo if photo is not None else F.lit(None).cast("struct<id:bigint>")).alias("photo"),
            (document if document is not None else F.lit(None).cast("struct<id:bigint>")).alias(
                "document"
            ),
            (video if video is not None else F.lit(None).cast("boolean")).alias("video"),
            (voice if voice is not None else F.lit(None).cast("boolean")).alias("voice"),
            (
                page
                if page is not None
                else F.lit(None).cast(
                    "struct<id:bigint,url:string,type:string,title:string,description:string>"
                )
            ).alias("webpage"),
        )

    number = F.col("event_id") * 10
    page = F.struct(
        (number + 1).alias("id"),
        _text("https://x.example/", "k").alias("url"),
        F.lit("article").alias("type"),
        _text("T", "k").alias("title"),
        F.when(k % 2 == 0, "d").alias("description"),
    )
    media = (
        F.when(kind == "view", media_struct("Photo", photo=F.struct(number.alias("id"))))
        .when(kind == "click", media_struct("WebPage", page=page))
        .when(
            kind == "purchase",
            media_struct(
                "Document",
                document=F.struct((number + 2).alias("id")),
                video=k % 2 == 0,
                voice=k % 3 == 0,
            ),
        )
        .when((kind == "signup") & (k % 5 == 0), media_struct("Poll"))
    )
    sender = (
        F.when(k % 4 == 0, _peer("PeerUser", "user_id", _text("u", "user_id")))
        .when(k % 4 == 1, _peer("PeerChannel", "channel_id", _text("c", "user_id")))
        .when(k % 4 == 2, _peer("PeerChat", "chat_id", _text("g", "k")))
    )
    reply = F.when(
        k % 3 == 0,
        F.struct(
            (F.col("event_id") - 1).alias("reply_to_msg_id"),
            F.when(k % 6 == 0, _peer("PeerChannel", "channel_id", _text("c", "user_id"))).alias(
                "reply_to_peer_id"
            ),
        ),
    )
    forward = F.when(
        k % 7 == 0,
        F.struct(
            _iso(F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("date"),
            F.when(k % 14 == 0, _peer("PeerChannel", "channel_id", _text("c", "k")))
            .otherwise(_peer("PeerUser", "user_id", _text("u", "k")))
            .alias("from_id"),
            k.alias("channel_post"),
        ),
    )
    replies = F.when(
        k % 2 == 1, F.struct(k.alias("replies"), F.when(k % 8 != 1, k % 4 == 1).alias("comments"))
    )

    def reaction(count: Column, emoticon: Column, document: Column) -> Column:
        return F.struct(
            count.cast("bigint").alias("count"),
            F.struct(
                emoticon.cast("string").alias("emoticon"),
                document.cast("bigint").alias("document_id"),
            ).alias("reaction"),
        )

    null = F.lit(None)
    results = F.array_compact(
        F.array(
            reaction(k, F.lit("A"), null),
            reaction(F.lit(1), null, k),
            F.when(k % 5 == 3, reaction(F.lit(2), F.lit("A"), null)),
        )
    )
    reactions = F.when(k % 5 > 0, F.struct(F.when(k % 5 > 1, results).alias("results")))
    action = F.when(
        k % 2 == 0,
        F.to_json(
            F.struct(
                F.lit("MessageActionChatEditTitle").alias("_"), _text("t", "k").alias("title")
            )
        ),
    ).otherwise(
        F.to_json(
            F.struct(
                F.lit("MessageActionChatAddUser").alias("_"),
                F.array("user_id", "k").alias("users"),
            )
        )
    )
    return events_k(spark, sf_dir).select(
        _text("c", "user_id").alias("channel_id"),
        F.date_format("ts", "yyyy-MM").alias("period"),
        "ts",
        "k",
        F.when(content, "Message").otherwise("MessageService").alias("_"),
        F.col("event_id").alias("id"),
        _iso(F.col("ts")).alias("date"),
        F.when(content, F.concat_ws(" ", "event_type", "props")).alias("message"),
        (k % 2 == 0).alias("silent"),
        (k % 10 == 0).alias("pinned"),
        F.round(F.col("value") * 100).cast("bigint").alias("views"),
        k.alias("forwards"),
        F.when(k == 99, F.col("event_id") - 1).alias("comments_msg_id"),
        F.when(k % 4 == 0, _iso(F.col("ts") + F.expr("INTERVAL 1 HOUR"))).alias("edit_date"),
        sender.alias("from_id"),
        media.alias("media"),
        forward.alias("fwd_from"),
        replies.alias("replies"),
        reply.alias("reply_to"),
        reactions.alias("reactions"),
        F.when(kind == "click", F.array(_text("https://x.example/", "k"))).alias("text_urls"),
        F.when(~content, action).otherwise(none).alias("action"),
    )


_RECORD = (
    "_",
    "id",
    "date",
    "message",
    "silent",
    "pinned",
    "views",
    "forwards",
    "comments_msg_id",
    "edit_date",
    "from_id",
    "media",
    "fwd_from",
    "replies",
    "reply_to",
    "reactions",
    "text_urls",
)


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines in ``value``, with ``channel_id, period, id, ts, k``."""
    rows = message_structs(spark, sf_dir)
    record = F.to_json(F.struct(*_RECORD))
    # The action is an object in the record, not text.
    with_action = F.concat(
        F.substring(record, F.lit(1), F.length(record) - 1), F.lit(',"action":'), "action", F.lit("}")
    )
    line = F.when(F.col("action").isNotNull(), with_action).otherwise(record)
    return rows.select("channel_id", "period", F.col("id").alias("line_id"), "ts", "k", line.alias("value"))


def raw_messages(spark: SparkSession, sf_dir: str, schema: Schema = RAW_MESSAGE) -> DataFrame:
    """Events decoded from their JSON lines, as ``scan_messages`` gives them."""
    lines = message_lines(spark, sf_dir).select("channel_id", "period", "value")
    return valid(decode(lines, schema))


# The flat message table over ``ev``, as SQL (both sides: content and service).
MESSAGES_SQL = f"""
{EVENTS_SQL},
msg AS (
  SELECT channel_id, strftime(ts, '%Y-%m') AS period, ts, k, event_type,
    event_id AS id, ts AS date,
    CASE WHEN event_type = 'error' THEN 'MessageService' ELSE 'Message' END AS tag,
    CASE WHEN event_type <> 'error' THEN event_type || ' ' || props END AS message,
    k % 2 = 0 AS silent, k % 10 = 0 AS pinned,
    CAST(round(value * 100) AS BIGINT) AS views, k AS forwards,
    CASE WHEN k = 99 THEN event_id - 1 END AS comments_msg_id,
    CASE WHEN k % 4 = 0 THEN ts + INTERVAL 1 HOUR END AS edit_date,
    CASE k % 4 WHEN 0 THEN 'PeerUser' WHEN 1 THEN 'PeerChannel' WHEN 2 THEN 'PeerChat' END AS from_type,
    CASE k % 4 WHEN 0 THEN 'u' || user_id WHEN 1 THEN 'c' || user_id WHEN 2 THEN 'g' || k END AS from_id,
    CASE event_type WHEN 'view' THEN 'photo' WHEN 'click' THEN 'webpage'
      WHEN 'purchase' THEN CASE WHEN k % 2 = 0 THEN 'video' WHEN k % 3 = 0 THEN 'voice' ELSE 'document' END
      WHEN 'signup' THEN CASE WHEN k % 5 = 0 THEN 'other' END END AS media_type,
    CASE event_type WHEN 'view' THEN event_id * 10 WHEN 'click' THEN event_id * 10 + 1
      WHEN 'purchase' THEN event_id * 10 + 2 END AS media_id,
    CASE WHEN event_type = 'click' THEN 'https://x.example/' || k END AS webpage_preview_url,
    CASE WHEN event_type = 'click' THEN 'article' END AS webpage_preview_type,
    CASE WHEN event_type = 'click' THEN 'T' || k END AS webpage_preview_title,
    CASE WHEN event_type = 'click' AND k % 2 = 0 THEN 'd' END AS webpage_preview_description,
    CASE WHEN k % 3 = 0 THEN event_id - 1 END AS replies_to_msg_id,
    CASE WHEN k % 6 = 0 THEN 'c' || user_id END AS replies_to_chan_id,
    CASE WHEN k % 7 = 0 THEN ts - INTERVAL 1 DAY END AS fwd_from_date,
    CASE WHEN k % 14 = 0 THEN 'PeerChannel' WHEN k % 7 = 0 THEN 'PeerUser' END AS fwd_from_type,
    CASE WHEN k % 14 = 0 THEN 'c' || k WHEN k % 7 = 0 THEN 'u' || k END AS fwd_from_id,
    CASE WHEN k % 7 = 0 THEN k END AS fwd_from_msg_id,
    CASE WHEN k % 2 = 1 THEN k ELSE 0 END AS nr_replies,
    CASE WHEN k % 2 = 0 THEN FALSE WHEN k % 8 <> 1 THEN k % 4 = 1 END AS has_comments,
    CASE WHEN k % 5 > 0 THEN TRUE ELSE FALSE END AS has_reactions,
    CASE WHEN k % 5 = 3 THEN 2 WHEN k % 5 > 1 THEN k END AS count_a,
    CASE WHEN k % 5 > 1 THEN 1 END AS count_doc,
    CASE WHEN event_type = 'click' THEN 'https://x.example/' || k END AS text_url
  FROM ev
),
content AS (SELECT * FROM msg WHERE tag = 'Message' AND comments_msg_id IS NULL)
"""


def named(**entries: Entry) -> dict[str, Entry]:
    return entries
