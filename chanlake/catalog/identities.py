"""Queries over pseudonyms: hashing, maps, redaction, nested anonymisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.catalog.base import (
    EVENTS_SQL,
    KEY,
    Entry,
    hmac_sql,
    list_text,
    message_structs,
    table,
)
from chanlake.functions.anonymise import anonymise_action
from chanlake.functions.nested import matching_chat
from chanlake.functions.pseudonym import hashed, keyed, unkeyed
from chanlake.functions.redact import redact_entities, rewrite
from chanlake.operators import anonymise as A
from chanlake.operators import pseudonyms as P
from chanlake.plans.message_tables import MessageTables, build_message_tables
from chanlake.plans.private_logs import STORED_PACKS, STORED_TEMPLATE, StoredLogs, store_private_logs
from chanlake.schemas import CHANNEL_DOC, PRIVATE_MESSAGE, ddl
from chanlake.session import work_path
from chanlake.sources.lists import scan_anon_maps
from chanlake.sources.messages import decode, valid
from chanlake.sources.packs import place_of, write_packs
from chanlake.sources.segments import segment_lines
from chanlake.sources.tables import write_version


def hmac_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, numeric ids and nulls."""
    customers = table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return P.with_hashes(
        customers, {"name_hash": "c_name", "key_hash": "c_custkey", "segment_hash": segment}, KEY
    ).select("c_custkey", "name_hash", "key_hash", "segment_hash")


HMAC_SQL = f"""SELECT c_custkey, {hmac_sql('c_name')} AS name_hash, {hmac_sql('c_custkey')} AS key_hash,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN {hmac_sql('c_mktsegment')} END AS segment_hash FROM customer"""


def customer_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pseudonym_map(table(spark, sf_dir, "customer").select(F.col("c_name").alias("original")), KEY)


def _tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer map where some rows carry another row's hash."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("original"),
        F.when(F.col("c_custkey") % 97 == 5, F.lit("Customer#000000000"))
        .otherwise(F.col("c_name"))
        .alias("hashed_name"),
    )
    return P.with_hashes(customers, {"hash": "hashed_name"}, KEY)


_TAMPERED_SQL = f"""bad AS (SELECT c_custkey, c_name AS original,
  {hmac_sql("CASE WHEN c_custkey % 97 = 5 THEN 'Customer#000000000' ELSE c_name END")} AS hash FROM customer)"""


def verify_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.verify_pseudonyms(_tampered(spark, sf_dir), KEY).select("original", "hash", "expected")


VERIFY_SQL = f"""WITH {_TAMPERED_SQL}
SELECT original, hash, {hmac_sql('original')} AS expected FROM bad WHERE hash <> {hmac_sql('original')}"""


def duplicate_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.duplicate_hashes(_tampered(spark, sf_dir))


DUPLICATE_SQL = f"""WITH {_TAMPERED_SQL},
many AS (SELECT hash, count(*) AS n FROM bad GROUP BY hash HAVING count(*) > 1)
SELECT count(*) AS hashes, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM many"""


def merge_anon_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of customers by segment, in files; a later file has another hash for some."""
    customers = table(spark, sf_dir, "customer")
    early = P.with_hashes(customers, {"hash": "c_name"}, KEY).select(
        F.col("c_name").alias("original"), "hash", F.lit("a").alias("part"), "c_mktsegment"
    )
    late = P.with_hashes(customers.filter("c_custkey % 10 = 3"), {"hash": "c_custkey"}, KEY).select(
        F.col("c_name").alias("original"), "hash", F.lit("b").alias("part"), "c_mktsegment"
    )
    pairs = early.unionByName(late)
    # The file order of the rule is (time, path): here all files share one time.
    files = pairs.select(
        "original",
        "hash",
        F.lit(0).cast("timestamp").alias("file_modified"),
        F.concat_ws("/", "part", "c_mktsegment").alias("file_path"),
    )
    merged = P.merge_maps_last_wins(files)
    old = early.filter("c_mktsegment = 'BUILDING'")
    return P.merge_anon_maps(old, merged).select("original", "hash")


MERGE_SQL = f"""
SELECT c_name AS original, CASE WHEN c_custkey % 10 = 3 THEN {hmac_sql('c_custkey')} ELSE {hmac_sql('c_name')} END AS hash
FROM customer
UNION SELECT c_name, {hmac_sql('c_name')} FROM customer WHERE c_mktsegment = 'BUILDING'"""


def scan_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' maps, one JSON object per nation written to disk and read back."""
    suppliers = P.with_hashes(table(spark, sf_dir, "supplier"), {"hash": "s_name"}, KEY)
    path = work_path(spark, "maps")
    # Objects of bounded size: as many entries as suppliers share a nation and hash part.
    part = F.pmod(F.xxhash64("s_name"), F.lit(64))
    objects = suppliers.groupBy("s_nationkey", part.alias("part")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("s_name", "hash")))).alias("value")
    )
    objects.write.partitionBy("s_nationkey", "part").text(path)
    return P.merge_maps_last_wins(scan_anon_maps(spark, path))


SCAN_MAPS_SQL = f"SELECT s_name AS original, {hmac_sql('s_name')} AS hash FROM supplier"


def deanonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by hashed customer; every seventh customer is missing from the map."""
    known = customer_map(spark, sf_dir).filter(F.right("original", F.lit(1)) != "7")
    orders = table(spark, sf_dir, "orders", spread=True).withColumn(
        "name", F.format_string("Customer#%09d", "o_custkey")
    )
    hashed_orders = P.with_hashes(orders, {"name": "name"}, KEY).select("o_orderkey", "name")
    return P.deanonymise(hashed_orders, known, "name").select("o_orderkey", "name")


DEANONYMISE_SQL = f"""
SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 7 THEN c_name ELSE {hmac_sql('c_name')} END AS name
FROM orders JOIN customer ON o_custkey = c_custkey"""


def safe_anonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders already hold a pseudonym."""
    orders = table(spark, sf_dir, "orders", spread=True).withColumn(
        "name", F.format_string("Customer#%09d", "o_custkey")
    )
    mixed = unkeyed(
        keyed(orders, KEY).withColumn(
            "name", F.when(F.col("o_orderkey") % 2 == 0, hashed(F.col("name"))).otherwise(F.col("name"))
        )
    ).select("o_orderkey", "name")
    known = customer_map(spark, sf_dir)
    return P.safe_anonymise(mixed, known, "name", KEY).select("o_orderkey", "name")


SAFE_SQL = f"""
SELECT o_orderkey, {hmac_sql('c_name')} AS name FROM orders JOIN customer ON o_custkey = c_custkey"""


def unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = customer_map(spark, sf_dir).filter(F.right("original", F.lit(1)) != "7")
    orders = table(spark, sf_dir, "orders", spread=True).withColumn(
        "name", F.format_string("Customer#%09d", "o_custkey")
    )
    return P.unmapped(P.with_hashes(orders, {"name": "name"}, KEY), known, "name")


UNMAPPED_SQL = f"""
SELECT DISTINCT {hmac_sql('c_name')} AS hash FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_custkey % 10 = 7"""

# An address in a text: the same pattern in both engines.
_EMAIL = "[A-Za-z0-9._-]+@[A-Za-z0-9.-]+[A-Za-z0-9]"


def redact_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; e-mail addresses are entities, with the spans found by pattern."""
    documents = table(spark, sf_dir, "documents", spread=True)
    # Alternating pieces: text, address, text, ... The offsets are running lengths.
    found = F.regexp_extract_all("text", F.lit(f"({_EMAIL})"), F.lit(1))
    rest = F.split("text", _EMAIL, -1)
    units = lambda c: (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")
    spans = F.aggregate(
        F.zip_with(F.slice(rest, F.lit(1), F.size(found)), found, lambda a, b: F.struct(units(a).alias("a"), units(b).alias("b"))),
        F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<offset:int,length:int>>").alias("spans")
        ),
        lambda acc, s: F.struct(
            (acc["at"] + s["a"] + s["b"]).alias("at"),
            F.concat(
                acc["spans"],
                F.array(F.struct((acc["at"] + s["a"]).alias("offset"), s["b"].alias("length"))),
            ).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    entities = F.transform(
        spans,
        lambda s: F.struct(
            F.lit("MessageEntityEmail").alias("_"),
            s["offset"].alias("offset"),
            s["length"].alias("length"),
            F.lit(None).cast("string").alias("url"),
        ),
    )
    rows = keyed(documents.withColumn("entities", entities), KEY)
    return unkeyed(
        rows.withColumn("redacted", redact_entities(F.col("text"), F.col("entities")))
    ).select("doc_id", "redacted")


REDACT_EMAILS_SQL = f"""
WITH hit AS (SELECT doc_id, text, regexp_extract_all(text, '{_EMAIL}') AS found,
    regexp_split_to_array(text, '{_EMAIL}') AS rest
  FROM documents),
piece AS (SELECT doc_id, i, rest[i] AS text, found[i] AS mail FROM hit, LATERAL unnest(range(1, len(rest) + 1)) t(i)),
coded AS (SELECT doc_id, i, text || coalesce({hmac_sql("split_part(mail, '@', 1)")} || '@' ||
    {hmac_sql("split_part(mail, '@', 2)")}, '') AS part FROM piece)
SELECT doc_id, redacted FROM documents LEFT JOIN
  (SELECT doc_id, string_agg(part, '' ORDER BY i) AS redacted FROM coded GROUP BY doc_id) USING (doc_id)"""


def _entity(kind: str, offset: Column, length: Column, url: Column | None = None) -> Column:
    return F.struct(
        F.lit(f"MessageEntity{kind}").alias("_"),
        offset.cast("int").alias("offset"),
        length.cast("int").alias("length"),
        (F.lit(None).cast("string") if url is None else url).alias("url"),
    )


def _order_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages: ``😀 hi @<customer>, see https://x.example/<order> bye``."""
    orders = table(spark, sf_dir, "orders", spread=True).withColumn(
        "name", F.format_string("Customer#%09d", "o_custkey")
    )
    link = F.concat(F.lit("https://x.example/"), "o_orderkey")
    text = F.concat(F.lit("😀 hi @"), "name", F.lit(", see "), link, F.lit(" bye"))
    size = F.length("name") + 1
    entities = F.array(
        _entity("Mention", F.lit(6), size),
        _entity("Url", F.lit(6) + size + 6, F.length(link)),
        _entity("TextUrl", F.lit(0), F.lit(2), F.concat(F.lit("http://t.example/"), "o_custkey")),
        _entity("Bold", F.lit(0), F.lit(5)),
    )
    return orders.select("o_orderkey", text.alias("message"), entities.alias("entities"))


def redact_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = keyed(_order_notes(spark, sf_dir), KEY)
    parts = rewrite(F.col("message"), F.col("entities"))
    return notes.select("o_orderkey", parts.alias("parts")).select(
        "o_orderkey",
        F.col("parts.message").alias("redacted"),
        list_text("parts.text_mentions").alias("mentions"),
        list_text("parts.text_urls").alias("urls"),
    )


_NAME = "printf('Customer#%09d', o_custkey)"
REDACT_MENTIONS_SQL = f"""
SELECT o_orderkey, '😀 hi @' || {hmac_sql(_NAME)} || ', see https://x.example/' || o_orderkey || ' bye' AS redacted,
  {hmac_sql(_NAME)} AS mentions, 'http://t.example/' || o_custkey || '|https://x.example/' || o_orderkey AS urls
FROM orders"""


def private_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of messages before pseudonymisation, with ``channel_id, period, k``."""
    rows = message_structs(spark, sf_dir)
    user = F.regexp_extract("channel_id", r"(\d+)", 1)
    peer = F.struct(F.lit("PeerChannel").alias("_"), user.cast("bigint").alias("channel_id"))
    name = F.concat(F.lit("user"), "k")
    text = F.concat(F.lit("hi @"), name, F.lit(" ok"))
    record = F.to_json(
        F.struct(
            "_",
            "id",
            "date",
            F.when(F.col("_") == "Message", text).alias("message"),
            peer.alias("peer_id"),
            "from_id",
            F.when(F.col("k") % 3 == 0, name).alias("post_author"),
            F.when(
                F.col("k") % 2 == 1,
                F.struct(
                    F.col("k").alias("replies"),
                    F.col("k").alias("channel_id"),
                    F.array(
                        F.struct(F.lit("PeerUser").alias("_"), F.col("k").alias("user_id"))
                    ).alias("recent_repliers"),
                ),
            ).alias("replies"),
            F.when(
                F.col("fwd_from").isNotNull(),
                F.struct(
                    F.col("fwd_from.date").alias("date"),
                    F.col("fwd_from.from_id").alias("from_id"),
                    name.alias("from_name"),
                ),
            ).alias("fwd_from"),
            F.when(
                (F.col("_") == "Message") & (F.col("k") % 6 == 0),
                F.struct(
                    F.lit("MessageMediaWebPage").alias("_"),
                    F.struct(
                        F.col("k").alias("id"),
                        F.concat(F.lit("https://x.example/"), "k").alias("url"),
                        F.struct(F.array("id").alias("blocks"), F.lit(True).alias("part")).alias("cached_page"),
                    ).alias("webpage"),
                ),
            ).alias("media"),
            F.when(
                F.col("_") == "Message",
                F.array(_entity("Mention", F.lit(3), F.length(name) + 1)),
            ).alias("entities"),
        )
    )
    with_action = F.concat(
        F.substring(record, F.lit(1), F.length(record) - 1), F.lit(',"action":'), "action", F.lit("}")
    )
    return rows.select("channel_id", "period", "k", F.coalesce(with_action, record).alias("value"))


def private_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages before pseudonymisation, decoded from JSON."""
    return valid(decode(private_lines(spark, sf_dir).drop("period"), PRIVATE_MESSAGE))


_MSG_SQL = f"""{EVENTS_SQL},
pm AS (SELECT channel_id, event_id AS id, k, user_id, event_type <> 'error' AS content, 'user' || k AS name FROM ev)"""


def preprocess_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = private_messages(spark, sf_dir).filter(F.col("_") == "Message")
    ready = A.preprocess_messages(content, KEY)
    return ready.select(
        "channel_id",
        "id",
        "message",
        list_text("text_mentions").alias("mentions"),
        F.col("peer_id.channel_id").alias("peer_channel"),
        F.coalesce("from_id.user_id", "from_id.channel_id", "from_id.chat_id").alias("sender"),
        "post_author",
        F.col("replies.channel_id").alias("replies_channel"),
        F.col("replies.recent_repliers")[0]["user_id"].alias("replier"),
        F.coalesce("fwd_from.from_id.channel_id", "fwd_from.from_id.user_id").alias("forwarded_from"),
        F.col("fwd_from.from_name").alias("forward_name"),
    )


PREPROCESS_SQL = f"""WITH {_MSG_SQL}
SELECT channel_id, id, 'hi @' || {hmac_sql('name')} || ' ok' AS message, {hmac_sql('name')} AS mentions,
  {hmac_sql('user_id')} AS peer_channel,
  CASE k % 4 WHEN 0 THEN {hmac_sql("'u' || user_id")} WHEN 1 THEN {hmac_sql("'c' || user_id")}
    WHEN 2 THEN {hmac_sql("'g' || k")} END AS sender,
  CASE WHEN k % 3 = 0 THEN {hmac_sql('name')} END AS post_author,
  CASE WHEN k % 2 = 1 THEN {hmac_sql('k')} END AS replies_channel,
  CASE WHEN k % 2 = 1 THEN {hmac_sql('k')} END AS replier,
  CASE WHEN k % 14 = 0 THEN {hmac_sql("'c' || k")} WHEN k % 7 = 0 THEN {hmac_sql("'u' || k")} END AS forwarded_from,
  CASE WHEN k % 7 = 0 THEN {hmac_sql('name')} END AS forward_name
FROM pm WHERE content"""


def collect_pseudonym_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every identity in content and service messages with its pseudonym."""
    return P.pseudonym_map(A.collect_identities(private_messages(spark, sf_dir)), KEY)


COLLECT_SQL = f"""WITH {_MSG_SQL},
ids AS (
  SELECT CAST(user_id AS VARCHAR) AS original FROM pm
  UNION SELECT CASE k % 4 WHEN 0 THEN 'u' || user_id WHEN 1 THEN 'c' || user_id WHEN 2 THEN 'g' || k END FROM pm
  UNION SELECT name FROM pm WHERE content
  UNION SELECT CAST(k AS VARCHAR) FROM pm WHERE content AND k % 2 = 1
  UNION SELECT CASE WHEN k % 14 = 0 THEN 'c' || k ELSE 'u' || k END FROM pm WHERE content AND k % 7 = 0
  UNION SELECT 't' || k FROM pm WHERE NOT content AND k % 2 = 0
  UNION SELECT CAST(k AS VARCHAR) FROM pm WHERE NOT content AND k % 2 = 1)
SELECT original, {hmac_sql('original')} AS hash FROM ids WHERE original IS NOT NULL"""


def forward_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.forward_origins(private_messages(spark, sf_dir)).distinct()


ORIGINS_SQL = f"""WITH {_MSG_SQL}
SELECT DISTINCT channel_id, 'c' || k AS forwarded_id FROM pm WHERE k % 14 = 0"""


_LOG = "channel_id={channel_id}/period={period}/{file}"


def private_logs_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over logs that grow: private logs on disk to stored logs, and those to tables.

    Every month comes in two parts, the second with a third of the first once more; then nothing new.

    All that it leaves: maps and forwards of channels, cached pages, pruned pages in stored
    messages, the message table and the service messages' kinds.
    """
    private, root = work_path(spark, "private-logs"), work_path(spark, "stored")
    lines = private_lines(spark, sf_dir).select("channel_id", "period", "value")
    part = F.pmod(F.xxhash64("value"), F.lit(6))
    names = ("messages", "maps", "forwards", "pages", "quarantine")
    stored = StoredLogs(*(f"{root}/{name}" for name in names))
    for grown in (lines.filter(part < 3), lines.filter(part > 1), None):
        if grown is not None:
            write_packs(grown, private, "channel_id", place_of("channel_id", "period"))
        store_private_logs(spark, private, stored, KEY, _LOG, "*.txt", 16, segments=1, packs=True, gzip=True)
    tables = MessageTables(f"{root}/message-table", f"{root}/service-table", f"{root}/bad")
    build_message_tables(spark, stored.messages, tables, 16, STORED_TEMPLATE, STORED_PACKS, packs=True)
    read = spark.read.parquet
    page = F.get_json_object("page", "$.url")
    text = segment_lines(spark, stored.messages, packs=True)
    blocks = F.get_json_object("value", "$.media.webpage.cached_page.blocks")
    parts = [
        ("map", read(stored.channel_maps), "channel_id", "original", "hash"),
        ("forward", read(stored.forwards), "channel_id", "forwarded_id", F.lit(None)),
        ("page", read(stored.cached_pages), F.lit(None), "media_id", page),
        ("pruned", text.filter(blocks.isNotNull()), "channel_id", F.get_json_object("value", "$.id"), blocks),
        ("message", read(tables.messages), "channel_id", "id", "message"),
        ("service", read(tables.service), "channel_id", "id", "action_type"),
    ]
    shown = [
        rows.select(F.lit(kind).alias("kind"), *(
            (F.col(c) if isinstance(c, str) else c).cast("string").alias(name)
            for c, name in zip(columns, ("channel_id", "item", "value"), strict=True)
        ))
        for kind, rows, *columns in parts
    ]
    return reduce(DataFrame.unionByName, shown)


STORED_SQL = f"""WITH {_MSG_SQL},
ids AS (
  SELECT channel_id, CAST(user_id AS VARCHAR) AS original FROM pm
  UNION SELECT channel_id, CASE k % 4 WHEN 0 THEN 'u' || user_id WHEN 1 THEN 'c' || user_id WHEN 2 THEN 'g' || k END FROM pm
  UNION SELECT channel_id, name FROM pm WHERE content
  UNION SELECT channel_id, CAST(k AS VARCHAR) FROM pm WHERE content AND k % 2 = 1
  UNION SELECT channel_id, CASE WHEN k % 14 = 0 THEN 'c' || k ELSE 'u' || k END FROM pm WHERE content AND k % 7 = 0
  UNION SELECT channel_id, 't' || k FROM pm WHERE NOT content AND k % 2 = 0
  UNION SELECT channel_id, CAST(k AS VARCHAR) FROM pm WHERE NOT content AND k % 2 = 1)
SELECT 'map' AS kind, channel_id, original AS item, {hmac_sql('original')} AS value FROM ids WHERE original IS NOT NULL
UNION ALL SELECT DISTINCT 'forward', channel_id, 'c' || k, NULL FROM pm WHERE k % 14 = 0
UNION ALL SELECT DISTINCT 'page', NULL, CAST(k AS VARCHAR), 'https://x.example/' || k FROM pm WHERE content AND k % 6 = 0
UNION ALL SELECT 'pruned', channel_id, CAST(id AS VARCHAR), '[]' FROM pm WHERE content AND k % 6 = 0
UNION ALL SELECT 'message', channel_id, CAST(id AS VARCHAR), 'hi @' || {hmac_sql('name')} || ' ok' FROM pm WHERE content
UNION ALL SELECT 'service', channel_id, CAST(id AS VARCHAR),
  CASE WHEN k % 2 = 0 THEN 'MessageActionChatEditTitle' ELSE 'MessageActionChatAddUser' END FROM pm WHERE NOT content"""


def anonymise_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = private_messages(spark, sf_dir).filter(F.col("_") == "MessageService")
    return keyed(rows, KEY).select("channel_id", "id", anonymise_action(F.col("action")).alias("action"))


SERVICE_SQL = f"""WITH {_MSG_SQL}
SELECT channel_id, id, CASE WHEN k % 2 = 0
  THEN '{{"_":"MessageActionChatEditTitle","title":"' || {hmac_sql("'t' || k")} || '"}}'
  ELSE '{{"_":"MessageActionChatAddUser","users":["' || {hmac_sql('user_id')} || '","' || {hmac_sql('k')} || '"]}}' END AS action
FROM pm WHERE NOT content"""


def channel_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as channel documents, decoded from JSON text (see ``catalog.channels``)."""
    from chanlake.catalog.channels import channel_texts

    texts = channel_texts(spark, sf_dir)
    record = F.from_json("value", ddl(CHANNEL_DOC))
    return texts.select("c_custkey", record.alias("d")).select("c_custkey", "d.*")


def anonymise_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = A.anonymise_channels(channel_docs(spark, sf_dir), KEY)
    full = F.col("full_chat")
    chat = matching_chat(F.col("chats"), full["id"])
    return docs.select(
        "c_custkey",
        chat["id"].alias("chat_id"),
        chat["title"].alias("title"),
        chat["username"].alias("username"),
        list_text(F.transform(chat["usernames"], lambda u: u["username"])).alias("usernames"),
        F.isnull(chat["photo"]).alias("photo_gone"),
        full["id"].alias("full_id"),
        full["linked_chat_id"].alias("linked"),
        list_text(F.col("recommended_channels")).alias("recommended"),
    )


ANON_CHANNEL_SQL = f"""
SELECT c_custkey, {hmac_sql('c_custkey')} AS chat_id, {hmac_sql('c_name')} AS title,
  CASE WHEN c_custkey % 3 > 0 THEN {hmac_sql("'user' || c_custkey")} END AS username,
  CASE WHEN c_custkey % 5 > 0 THEN {hmac_sql("'alt' || c_custkey")} || '|' || {hmac_sql("'old' || c_custkey")} END AS usernames,
  TRUE AS photo_gone, {hmac_sql('c_custkey')} AS full_id,
  CASE WHEN c_custkey % 4 = 0 THEN {hmac_sql('c_custkey + 1000000')} END AS linked,
  {hmac_sql('c_custkey + 1')} || '|' || {hmac_sql('c_custkey + 7')} AS recommended
FROM customer"""


def anonymise_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents hashed before come again: what the map knows stays; a title of every third that
    only looks like a pseudonym is hashed."""
    raw = channel_docs(spark, sf_dir)
    anon_map = P.collect_pseudonym_map(raw, A.channel_identities(), KEY)
    fake = F.sha2(F.col("c_name"), 256)
    named = raw.join(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")
    once = A.anonymise_channels(named, KEY)
    titled = F.transform("chats", lambda c: F.when(c["id"] == F.col("full_chat.id"), c.withField("title", fake)).otherwise(c))
    again = once.withColumn("chats", F.when(F.col("c_custkey") % 3 == 0, titled).otherwise(F.col("chats")))
    docs = A.anonymise_channels(again, KEY, anon_map=anon_map)
    chat = matching_chat(F.col("chats"), F.col("full_chat.id"))
    return docs.select(
        "c_custkey",
        chat["id"].alias("chat_id"),
        chat["title"].alias("title"),
        chat["username"].alias("username"),
        F.col("full_chat.linked_chat_id").alias("linked"),
    )


KNOWN_SQL = f"""
SELECT c_custkey, {hmac_sql('c_custkey')} AS chat_id,
  CASE WHEN c_custkey % 3 = 0 THEN {hmac_sql('sha256(c_name)')} ELSE {hmac_sql('c_name')} END AS title,
  CASE WHEN c_custkey % 3 > 0 THEN {hmac_sql("'user' || c_custkey")} END AS username,
  CASE WHEN c_custkey % 4 = 0 THEN {hmac_sql('c_custkey + 1000000')} END AS linked
FROM customer"""


def anonymise_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_name").alias("username"),
        F.lit("555").alias("phone"),
        (F.col("c_nationkey") % 2 == 0).alias("bot"),
    )
    return A.anonymise_users(users, KEY)


ANON_USERS_SQL = f"""
SELECT {hmac_sql('c_custkey')} AS id, CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
  CAST(NULL AS VARCHAR) AS username, CAST(NULL AS VARCHAR) AS phone, c_nationkey % 2 = 0 AS bot FROM customer"""


def write_anon_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map as a versioned table, written and read back."""
    path = write_version(customer_map(spark, sf_dir), work_path(spark, "anon-map"), "1")
    return spark.read.parquet(path)


WRITE_MAP_SQL = f"SELECT c_name AS original, {hmac_sql('c_name')} AS hash FROM customer"

ENTRIES: dict[str, Entry] = {
    "hmac_customers": (hmac_customers, HMAC_SQL),
    "verify_pseudonyms": (verify_pseudonyms, VERIFY_SQL),
    "duplicate_hashes": (duplicate_hashes, DUPLICATE_SQL),
    "merge_anon_maps": (merge_anon_maps, MERGE_SQL),
    "scan_anon_maps": (scan_maps, SCAN_MAPS_SQL),
    "deanonymise": (deanonymise, DEANONYMISE_SQL),
    "safe_anonymise": (safe_anonymise, SAFE_SQL),
    "unmapped": (unmapped, UNMAPPED_SQL),
    "redact_emails": (redact_emails, REDACT_EMAILS_SQL),
    "redact_mentions": (redact_mentions, REDACT_MENTIONS_SQL),
    "preprocess_messages": (preprocess_messages, PREPROCESS_SQL),
    "store_private_logs": (private_logs_stored, STORED_SQL),
    "collect_pseudonym_map": (collect_pseudonym_map, COLLECT_SQL),
    "forward_origins": (forward_origins, ORIGINS_SQL),
    "anonymise_service": (anonymise_service, SERVICE_SQL),
    "anonymise_channel": (anonymise_channel, ANON_CHANNEL_SQL),
    "anonymise_known": (anonymise_known, KNOWN_SQL),
    "anonymise_users": (anonymise_users, ANON_USERS_SQL),
    "write_anon_map": (write_anon_map, WRITE_MAP_SQL),
}
