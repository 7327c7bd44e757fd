"""Queries over texts: cleaning, search bot replies, language, keyword search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.catalog.base import EVENTS_SQL, Entry, events_k, list_text, table
from chanlake.functions.text import (
    channel_text,
    clean_text,
    extract_usernames,
    quota_exhausted,
)
from chanlake.operators.language import MARGIN, SCALE, detect_language, train_profiles
from chanlake.operators.search import pending_keywords, search_channels
from chanlake.operators.word_index import WordIndex
from chanlake.plans.keywords import bot_seeds
from chanlake.session import discard, materialised, work_path
from chanlake.sources.lists import scan_keywords
from chanlake.sources.tables import write_version

LANGUAGES = ["de", "en", "es", "fr"]


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with handles, tags and links put before and after them."""
    documents = table(spark, sf_dir, "documents", spread=True)
    text = F.concat(
        F.lit("@"), "lang", F.lit("_"), "source", F.lit(" a@b #"), "source", F.lit(" "), "text",
        F.lit(" see https://x.example/"), "doc_id", F.lit(" or www.y.example, t.me/"), "source", F.lit(" end"),
    )
    return documents.select("doc_id", clean_text(text).alias("cleaned"))


# The same rule in a dialect without Unicode word classes, over texts that have no
# handle next to an accented letter.
CLEAN_SQL = r"""
SELECT doc_id, regexp_replace('@' || lang || '_' || source || ' a@b #' || source || ' ' || text ||
  ' see https://x.example/' || doc_id || ' or www.y.example, t.me/' || source || ' end',
  '(?:(?:^|\B)[@#][\p{L}\p{N}_]+)|(?:(?:https?://|www\.|t\.me/)\S+)', '', 'g') AS cleaned
FROM documents"""


def channel_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    title = F.when(F.col("c_custkey") % 5 > 0, F.col("c_name"))
    about = F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment"))
    return customers.select("c_custkey", channel_text(title, about).alias("text"))


CHANNEL_TEXT_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN c_name ELSE '' END || '. ' ||
  CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS text FROM customer"""


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search bot replies: views list results, clicks hit the quota, others say nothing."""
    reply = (
        F.when(
            F.col("event_type") == "view",
            F.concat(
                F.lit("1 result: @user"), "user_id", F.lit(", @user_"), "k", F.lit(" and a@b")
            ),
        )
        .when(F.col("event_type") == "click", "You have exhausted your daily free searches")
        .otherwise(F.concat(F.lit("wait, @user"), "k"))
    )
    return events_k(spark, sf_dir).select("event_id", "user_id", "k", reply.alias("reply"))


def usernames_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.col("reply")
    return _replies(spark, sf_dir).select(
        "event_id",
        list_text(extract_usernames(reply)).alias("names"),
        quota_exhausted(reply).alias("quota"),
    )


USERNAMES_SQL = f"""WITH {EVENTS_SQL}
SELECT event_id, CASE WHEN event_type = 'view' THEN 'user' || user_id || '|user_' || k || '|b' END AS names,
  event_type = 'click' AS quota FROM ev"""


def seeds_from_bot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in replies looked up among the channels."""
    channels = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("user"), "c_custkey").alias("username"),
        (F.col("c_custkey") * 3).alias("access_hash"),
    )
    return bot_seeds(_replies(spark, sf_dir), channels)


BOT_SEEDS_SQL = """
SELECT DISTINCT c_custkey AS channel_id, c_custkey * 3 AS access_hash
FROM customer JOIN events ON user_id = c_custkey WHERE event_type = 'view'"""


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", spread=True).select(
        "doc_id", F.col("lang").alias("language"), "text"
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles trained on the documents' own labels, and the language each text gets."""
    documents = _labelled(spark, sf_dir)
    profiles = train_profiles(documents)
    return detect_language(documents.select("doc_id", "text"), profiles, LANGUAGES, ["doc_id"])


def language_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: texts that the profiles were not trained on, and how many they get right."""
    documents = _labelled(spark, sf_dir)
    profiles = train_profiles(documents.filter("doc_id % 2 = 0"))
    held_out = documents.filter("doc_id % 2 = 1")
    found = detect_language(held_out.select("doc_id", "text"), profiles, LANGUAGES, ["doc_id"])
    right = F.col("found") == F.upper("language")
    return (
        held_out.select("doc_id", "language")
        .join(found.withColumnRenamed("language", "found"), "doc_id")
        .groupBy("language")
        .agg(F.count("*").alias("texts"), F.count_if(right).alias("right"), F.count("found").alias("answered"))
    )


def _detected_sql(trained: str, asked: str) -> str:
    return rf"""
clean AS (SELECT doc_id, lang,
    string_split(' ' || trim(regexp_replace(lower(text), '[^\p{{L}}]+', ' ', 'g')) || ' ', '') AS c FROM documents),
tri AS (SELECT doc_id, lang, c[i] || c[i + 1] || c[i + 2] AS trigram
  FROM clean, LATERAL unnest(range(1, len(c) - 1)) t(i)),
counts AS (SELECT lang, trigram, count(*) AS n FROM tri WHERE {trained} GROUP BY 1, 2),
total AS (SELECT lang, sum(n) + count(*) AS total FROM counts GROUP BY lang),
weight AS (SELECT lang, trigram, CAST(round(ln((n + 1) / total) * {SCALE}) AS BIGINT) AS w FROM counts JOIN total USING (lang)),
floor AS (SELECT lang, CAST(round(ln(1 / total) * {SCALE}) AS BIGINT) AS w FROM total),
seen AS (SELECT doc_id, trigram, count(*) AS n FROM tri
  WHERE {asked} AND trigram IN (SELECT trigram FROM counts) GROUP BY 1, 2),
score AS (SELECT s.doc_id, f.lang, sum(s.n * coalesce(weight.w, f.w)) AS score, sum(s.n) AS n
  FROM seen s CROSS JOIN floor f LEFT JOIN weight ON weight.lang = f.lang AND weight.trigram = s.trigram GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang DESC) AS r,
    lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, lang DESC) AS next FROM score),
found AS (SELECT d.doc_id, d.lang, CASE WHEN score - next >= n * {MARGIN} THEN upper(ranked.lang) END AS language
  FROM documents d LEFT JOIN ranked ON ranked.doc_id = d.doc_id AND r = 1 WHERE {asked.replace("doc_id", "d.doc_id")})"""


LANGUAGES_SQL = f"WITH {_detected_sql('TRUE', 'TRUE')} SELECT doc_id, language FROM found"
ACCURACY_SQL = f"""WITH {_detected_sql('doc_id % 2 = 0', 'doc_id % 2 = 1')}
SELECT lang AS language, count(*) AS texts, count(*) FILTER (WHERE language = upper(lang)) AS "right",
  count(language) AS answered FROM found GROUP BY lang"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", spread=True).select(
        F.col("p_partkey").alias("id"),
        F.concat_ws(". ", "p_name", "p_brand", "p_type").alias("text"),
    )


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and single words, in capitals."""
    parts = table(spark, sf_dir, "part")
    phrases = parts.select(F.upper("p_name").alias("keyword"))
    words = parts.select(F.explode(F.split("p_name", " ")).alias("keyword"))
    return phrases.unionByName(words).distinct()


def channels_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts that a keyword matches."""
    return search_channels(_parts(spark, sf_dir), _keywords(spark, sf_dir), F.col("text")).select(
        "keyword", "id"
    )


_KEYWORDS_SQL = """kw AS (SELECT upper(p_name) AS keyword FROM part
  UNION SELECT unnest(string_split(p_name, ' ')) FROM part)"""
CHANNELS_FOUND_SQL = f"""WITH {_KEYWORDS_SQL},
txt AS (SELECT p_partkey AS id, ' ' || trim(regexp_replace(lower(p_name || ' ' || p_brand || ' ' || p_type), '[^a-z0-9_]+', ' ', 'g')) || ' ' AS t FROM part),
hit AS (SELECT keyword, id FROM kw JOIN txt ON contains(t, ' ' || lower(keyword) || ' '))
SELECT keyword, id FROM hit"""


def index_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts that a keyword matches, by a stored word index that took in half of the parts with
    another text first, and then all of them."""
    parts = _parts(spark, sf_dir)
    index = WordIndex(spark, work_path(spark, "word-index"))
    index.update(parts.filter("id % 2 = 0"), F.concat(F.col("text"), F.lit(" lavender almond")))
    index.update(parts, F.col("text"))
    hits = index.search(_keywords(spark, sf_dir)).select("keyword", F.col("id").cast("bigint").alias("id"))
    found = materialised(hits, "found")
    discard(spark, index.root)
    return found


def keywords_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword lists written as text, read back; those of large parts are searched."""
    parts = table(spark, sf_dir, "part")
    path = work_path(spark, "keywords")
    parts.select(F.concat("p_name", F.lit(" "), "p_brand")).write.text(path)
    searched = parts.filter("p_size > 25").select(
        F.concat("p_name", F.lit(" "), "p_brand").alias("keyword")
    )
    return pending_keywords(scan_keywords(spark, path), searched)


PENDING_SQL = """
SELECT p_name || ' ' || p_brand AS keyword FROM part EXCEPT
SELECT p_name || ' ' || p_brand FROM part WHERE p_size > 25"""


def searched_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The searched keywords as a versioned table."""
    words = _keywords(spark, sf_dir)
    return spark.read.parquet(write_version(words, work_path(spark, "searched"), "1"))


SEARCHED_SQL = f"WITH {_KEYWORDS_SQL} SELECT keyword FROM kw"

ENTRIES: dict[str, Entry] = {
    "clean_text": (cleaned, CLEAN_SQL),
    "channel_text": (channel_texts, CHANNEL_TEXT_SQL),
    "extract_usernames": (usernames_found, USERNAMES_SQL),
    "bot_seeds": (seeds_from_bot, BOT_SEEDS_SQL),
    "detect_language": (languages, LANGUAGES_SQL),
    "language_accuracy": (language_accuracy, ACCURACY_SQL),
    "search_channels": (channels_found, CHANNELS_FOUND_SQL),
    "search_word_index": (index_searched, CHANNELS_FOUND_SQL),
    "pending_keywords": (keywords_pending, PENDING_SQL),
    "write_searched_keywords": (searched_written, SEARCHED_SQL),
}
