"""Queries over the channel graph.

Parts are channels that forward from suppliers, customers are channels whose orders
point to other customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.catalog.base import Entry, KEY, hmac_sql, list_text, table
from chanlake.catalog.channels import channel_docs
from chanlake.operators import filters, graph
from chanlake.operators import pseudonyms as P
from chanlake.operators.flatten import flatten_channels
from chanlake.operators.neighbours import NeighbourSets
from chanlake.session import materialised, work_path

NOW = "2024-06-01 12:00:00"


def part_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as messages of a part's channel, forwarded from the supplier's."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("p"), "l_partkey").alias("channel_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("l_returnflag") == "R", "PeerUser").otherwise("PeerChannel").alias("fwd_from_type"),
        F.concat(F.lit("s"), "l_suppkey").alias("fwd_from_id"),
        "l_shipdate",
        "l_linenumber",
    )


_PAIRS_SQL = """pairs AS (SELECT DISTINCT 'p' || l_partkey AS channel_id, 's' || l_suppkey AS source_id
  FROM lineitem WHERE l_returnflag <> 'R')"""


def forwards_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a saved set: the first lines of orders, whatever their kind."""
    messages = part_messages(spark, sf_dir)
    saved = messages.filter("l_linenumber = 1").select(
        "channel_id", F.col("fwd_from_id").alias("source_id")
    )
    found = graph.forwards_from(messages, saved)
    return found.select("channel_id", "page", list_text("forwards_from").alias("forwards_from"))


FORWARDS_SQL = f"""WITH {_PAIRS_SQL},
both_sets AS (SELECT * FROM pairs UNION
  SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem WHERE l_linenumber = 1)
SELECT channel_id, CAST(0 AS INTEGER) AS page, string_agg(source_id, '|' ORDER BY source_id) AS forwards_from
FROM both_sets GROUP BY 1"""


def stored_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that suppliers ship as stored sets that grow in three rounds and are split as they do."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), (F.col("l_suppkey") % 9).cast("string")).alias("channel_id"),
        F.col("l_partkey").cast("string").alias("member"), "l_linenumber",
    )
    sets = NeighbourSets(spark, work_path(spark, "neighbours"), 50, 16)
    sets.add(lines.filter("l_linenumber = 1"))
    first = materialised(sets.pages(), "first-pages")
    sets.add(lines.filter("l_linenumber <= 3"))
    sets.add(lines)
    once = sets.pairs().groupBy("channel_id").agg(
        F.count("*").alias("members"), F.min("member").alias("first"), F.max("member").alias("last")
    )
    pages = sets.pages().groupBy("channel_id").agg(
        (F.max(F.size("members")) <= 100).alias("bounded"), (F.count_distinct("depth") == 1).alias("one_depth")
    )
    grown = sets.pages().groupBy("channel_id").agg(F.max("depth").alias("now")).join(
        first.groupBy("channel_id").agg(F.max("depth").alias("was")), "channel_id"
    )
    deeper = grown.select("channel_id", (F.col("now") >= F.col("was")).alias("deeper"))
    return once.join(pages, "channel_id").join(deeper, "channel_id").join(sets.sizes(), "channel_id")


STORED_NEIGHBOURS_SQL = """
SELECT 's' || l_suppkey % 9 AS channel_id, count(DISTINCT l_partkey) AS members, min(CAST(l_partkey AS VARCHAR)) AS first,
  max(CAST(l_partkey AS VARCHAR)) AS last, TRUE AS bounded, TRUE AS one_depth, TRUE AS deeper, count(DISTINCT l_partkey) AS n
FROM lineitem GROUP BY 1"""


def recommended_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts recommend their suppliers: hundreds of recommenders each."""
    edges = part_messages(spark, sf_dir).select(
        F.col("channel_id").alias("src"), F.col("fwd_from_id").alias("dst"), F.lit("recommend").alias("kind")
    )
    found = graph.recommended_by(edges)
    return found.select("channel_id", "page", list_text("recommended_by").alias("recommended_by"))


RECOMMENDED_SQL = """
WITH pairs AS (SELECT DISTINCT 'p' || l_partkey AS src, 's' || l_suppkey AS channel_id FROM lineitem)
SELECT channel_id, CAST(0 AS INTEGER) AS page, string_agg(src, '|' ORDER BY src) AS recommended_by FROM pairs GROUP BY 1"""


def last_forward_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are ship months."""
    view = part_messages(spark, sf_dir).select(
        "channel_id",
        "id",
        F.struct(
            F.struct(
                F.when(F.col("fwd_from_type") == "PeerChannel", F.col("fwd_from_id")).alias("channel_id")
            ).alias("from_id")
        ).alias("fwd_from"),
        F.when(
            F.col("l_linenumber") > 1, F.struct((F.col("id") - 1).alias("reply_to_msg_id"))
        ).alias("reply_to"),
        F.date_format("l_shipdate", "yyyy-MM").alias("file_path"),
    )
    return graph.last_forward_per_source(view)


LAST_FORWARD_SQL = """
WITH m AS (SELECT 'p' || l_partkey AS channel_id, 's' || l_suppkey AS source_id, l_orderkey * 10 + l_linenumber AS id,
    CASE WHEN l_linenumber > 1 THEN l_orderkey * 10 + l_linenumber - 1 END AS reply_to,
    strftime(l_shipdate, '%Y-%m') AS file FROM lineitem WHERE l_returnflag <> 'R'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY channel_id, source_id ORDER BY file DESC, id DESC) AS r FROM m)
SELECT channel_id, source_id, id, reply_to FROM ranked WHERE r = 1"""


def channel_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.channel_edges(channel_docs(spark, sf_dir))


EDGES_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS src, CAST(c_custkey + 1 AS VARCHAR) AS dst, 'recommend' AS kind FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), CAST(c_custkey + 7 AS VARCHAR), 'recommend' FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), CAST(c_custkey + 2 AS VARCHAR), 'forward' FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), CAST(c_custkey + 1000000 AS VARCHAR), 'linked' FROM customer WHERE c_custkey % 4 = 0"""


def edge_channel_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = channel_docs(spark, sf_dir)
    channels = flatten_channels(docs).select("id", "title", "pts")
    return graph.edge_channel_lookup(graph.channel_edges(docs), channels).select(
        "src", "dst", "kind", "title", "pts", "has_doc"
    )


LOOKUP_SQL = f"""WITH edges AS ({EDGES_SQL})
SELECT src, dst, kind, c_name AS title, c_custkey * 2 AS pts, c_custkey IS NOT NULL AS has_doc
FROM edges LEFT JOIN customer ON dst = CAST(c_custkey AS VARCHAR)"""


def _hashed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = graph.forward_pairs(part_messages(spark, sf_dir))
    return P.with_hashes(pairs, {"source_id": "source_id"}, KEY)


def _supplier_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    ids = suppliers.select(F.concat(F.lit("s"), "s_suppkey").alias("original"))
    return P.pseudonym_map(ids, KEY)


def forward_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources found in the map, and those the map lacks."""
    found, missing = graph.forward_sources(_hashed_pairs(spark, sf_dir), _supplier_map(spark, sf_dir))
    return found.select("channel_id", "source_id", "original_id").unionByName(
        missing.withColumn("original_id", F.lit(None).cast("string"))
    )


SOURCES_SQL = f"""WITH {_PAIRS_SQL}
SELECT channel_id, {hmac_sql('source_id')} AS source_id, CASE WHEN s_acctbal > 0 THEN source_id END AS original_id
FROM pairs JOIN supplier ON source_id = 's' || s_suppkey"""


def issue_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of documents to channels that have none."""
    docs = channel_docs(spark, sf_dir)
    pairs = graph.channel_edges(docs).select(
        F.col("src").alias("channel_id"), F.col("dst").alias("source_id")
    )
    return graph.issue_table(pairs, docs.select(F.col("full_chat.id").alias("id")))


ISSUE_SQL = f"""WITH edges AS ({EDGES_SQL})
SELECT DISTINCT src AS channel_id, dst AS source_id FROM edges
WHERE dst NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)"""


def new_forwards(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = part_messages(spark, sf_dir)
    chunk = graph.forward_pairs(messages.filter("l_shipdate >= timestamp'1999-01-01'"))
    known = graph.forward_pairs(messages.filter("l_shipdate < timestamp'1999-01-01'"))
    return graph.new_forwards(chunk, known)


NEW_FORWARDS_SQL = """
SELECT 'p' || l_partkey AS channel_id, 's' || l_suppkey AS source_id FROM lineitem
WHERE l_returnflag <> 'R' AND l_shipdate >= TIMESTAMP '1999-01-01'
EXCEPT SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
WHERE l_returnflag <> 'R' AND l_shipdate < TIMESTAMP '1999-01-01'"""


def merge_edge_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    old = F.when(F.col("c_custkey") % 3 > 0, F.array(F.concat(F.lit("b"), key), F.concat(F.lit("a"), key)))
    new = F.when(F.col("c_custkey") % 5 > 0, F.array(F.concat(F.lit("c"), key), F.concat(F.lit("a"), key)))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", list_text(graph.merge_edge_lists(old, new)).alias("merged")
    )


MERGE_LISTS_SQL = """
SELECT c_custkey, concat_ws('|', CASE WHEN c_custkey % 3 > 0 OR c_custkey % 5 > 0 THEN 'a' || c_custkey END,
  CASE WHEN c_custkey % 3 > 0 THEN 'b' || c_custkey END, CASE WHEN c_custkey % 5 > 0 THEN 'c' || c_custkey END) AS merged
FROM customer"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items name candidates: those flagged N recommend, others forward; priority by quantity."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("channel_id"),
        F.col("l_quantity").cast("bigint").alias("priority"),
        "l_returnflag",
    )
    recommends = F.col("l_returnflag") == "N"
    pick = lambda kind: items.filter(kind).drop("l_returnflag")
    return graph.merge_candidates(pick(~recommends), pick(recommends))


_CANDIDATES_SQL = """cand AS (
  SELECT l_partkey AS channel_id, coalesce(min(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag = 'N'),
    min(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag <> 'N')) AS priority
  FROM lineitem GROUP BY 1)"""


def merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)


def minus_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "part").filter("p_size < 20").select(F.col("p_partkey").alias("channel_id"))
    return graph.minus_processed(_candidates(spark, sf_dir), done)


MINUS_SQL = f"""WITH {_CANDIDATES_SQL}
SELECT * FROM cand WHERE channel_id NOT IN (SELECT p_partkey FROM part WHERE p_size < 20)"""


def frontier_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All channels in the order they would be explored."""
    return graph.frontier_order(_candidates(spark, sf_dir))


FRONTIER_SQL = f"WITH {_CANDIDATES_SQL} SELECT * FROM cand ORDER BY priority, channel_id"


def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("channel_id"), "p_size")
    return graph.run_progress(parts, parts.filter("p_size < 20"))


PROGRESS_SQL = """
SELECT count(*) FILTER (WHERE p_size < 20) AS processed, count(*) FILTER (WHERE p_size >= 20) AS remaining FROM part"""

# Customers as channels: language by nation, private when in debt, spam when rich.
_LANGUAGES = ("EN", "FR", None, "DE")


def _language(nation: Column) -> Column:
    result = F.lit(None).cast("string")
    for i, language in enumerate(_LANGUAGES):
        result = F.when(nation % 4 == i, F.lit(language).cast("string")).otherwise(result)
    return result


def _customer_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.date_sub(F.to_timestamp(F.lit(NOW)), (F.col("c_custkey") % 400).cast("int"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("channel_id"),
        (F.col("c_acctbal") >= 0).alias("has_doc"),
        F.col("c_acctbal").cast("bigint").alias("pts"),
        (F.col("c_custkey") % 200).alias("participants"),
        created.cast("timestamp").alias("created"),
        _language(F.col("c_nationkey")).alias("language"),
    )


_STEP_SQL = "CASE c_nationkey % 4 WHEN 0 THEN 2 WHEN 2 THEN 100 ELSE 1 END"
# The creation day starts at midnight, half a day before now.
_SPAM_SQL = (
    "(CAST(trunc(c_acctbal) AS BIGINT) / (1 + c_custkey % 200 * (1 + c_custkey % 400))::DOUBLE > 0.1)"
)


def exploration_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _customer_nodes(spark, sf_dir)
    now = F.to_timestamp(F.lit(NOW))
    spam = graph.looks_like_spam(F.col("pts"), F.col("participants"), F.col("created"), now)
    priority = graph.exploration_priority(
        F.col("has_doc"), spam, F.col("language"), F.col("c_custkey") % 10
    )
    return nodes.select("channel_id", priority.alias("priority"))


PRIORITY_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS channel_id, CAST(CASE WHEN c_acctbal < 0 THEN 10000000
  WHEN {_SPAM_SQL} THEN 9999999 ELSE c_custkey % 10 + {_STEP_SQL} END AS BIGINT) AS priority FROM customer"""


def explorable(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = exploration_priority(spark, sf_dir)
    return filters.explorable(scored, graph.PRIVATE_PRIORITY)


EXPLORABLE_SQL = f"SELECT * FROM ({PRIORITY_SQL}) WHERE priority < 10000000"


def lang_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    step = graph.lang_priority(F.upper("lang")).cast("bigint")
    return documents.groupBy("lang").agg(F.sum(step).alias("steps"), F.count("*").alias("documents"))


LANG_SQL = """
SELECT lang, CAST(sum(CASE lang WHEN 'en' THEN 2 WHEN 'fr' THEN 1 WHEN 'es' THEN 1 WHEN 'de' THEN 1 ELSE 100 END) AS BIGINT)
  AS steps, count(*) AS documents FROM documents GROUP BY lang"""


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges from each order's customer to another one, some customers linked in pairs."""
    nodes = _customer_nodes(spark, sf_dir)
    now = F.to_timestamp(F.lit(NOW))
    spam = graph.looks_like_spam(F.col("pts"), F.col("participants"), F.col("created"), now)
    customers = nodes.agg(F.count("*")).scalar()
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("src"),
        ((F.col("o_orderkey") * 7 + 3) % customers).cast("string").alias("dst"),
        F.when(F.col("o_orderstatus") == "F", graph.FORWARD).otherwise(graph.RECOMMEND).alias("kind"),
    )
    pair = nodes.filter("c_custkey % 50 < 2").select(
        F.col("channel_id").alias("src"),
        (F.col("c_custkey") + 1 - 2 * (F.col("c_custkey") % 50)).cast("string").alias("dst"),
        F.lit(graph.LINKED).alias("kind"),
    )
    seeds = nodes.filter("has_doc and pts between 100 and 130").select("channel_id")
    info = nodes.select("channel_id", "has_doc", spam.alias("spam"), "language")
    return orders.unionByName(pair), info, seeds


def snowball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.snowball(*_graph(spark, sf_dir))


# Shortest distances by relaxation: the keyed recursion keeps the best row per channel.
_SNOWBALL_SQL = f"""
RECURSIVE node AS (SELECT c_custkey AS id, c_acctbal >= 0 AS has_doc, {_SPAM_SQL} AS spam, {_STEP_SQL} AS step,
    CAST(trunc(c_acctbal) AS BIGINT) AS pts FROM customer),
edge AS (SELECT DISTINCT o_custkey AS src, (o_orderkey * 7 + 3) % (SELECT count(*) FROM customer) AS dst FROM orders),
target AS (SELECT src, dst, spam, step FROM edge JOIN node ON dst = id WHERE has_doc),
hop AS (
  SELECT src AS origin, dst, spam, step FROM target
  UNION SELECT c_custkey + 1 - 2 * (c_custkey % 50), dst, spam, step
  FROM target JOIN customer ON src = c_custkey WHERE c_custkey % 50 < 2 AND c_acctbal >= 0),
best(id, priority) USING KEY (id) AS (
  SELECT id, CAST(CASE WHEN spam THEN 9999999 ELSE step END AS BIGINT) FROM node WHERE has_doc AND pts BETWEEN 100 AND 130
  UNION
  SELECT n.id, n.priority FROM (
    SELECT dst AS id, min(CASE WHEN spam THEN 9999999 ELSE priority + step END) AS priority
    FROM best JOIN hop ON hop.origin = best.id GROUP BY dst) n
  LEFT JOIN recurring.best old ON old.id = n.id
  WHERE n.priority < 10000000 AND (old.priority IS NULL OR n.priority < old.priority))"""
SNOWBALL_SQL = f"WITH {_SNOWBALL_SQL} SELECT CAST(id AS VARCHAR) AS channel_id, priority FROM best"


def crawl_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of visits; all channels stay in it."""
    return graph.crawl_order(snowball(spark, sf_dir), "place")


CRAWL_SQL = f"""WITH {_SNOWBALL_SQL}
SELECT CAST(id AS VARCHAR) AS channel_id, priority,
  row_number() OVER (ORDER BY priority, CAST(id AS VARCHAR)) AS place FROM best"""

ENTRIES: dict[str, Entry] = {
    "forwards_from": (forwards_from, FORWARDS_SQL),
    "recommended_by": (recommended_by, RECOMMENDED_SQL),
    "neighbour_sets": (stored_neighbours, STORED_NEIGHBOURS_SQL),
    "last_forward_per_source": (last_forward_per_source, LAST_FORWARD_SQL),
    "channel_edges": (channel_edges, EDGES_SQL),
    "edge_channel_lookup": (edge_channel_lookup, LOOKUP_SQL),
    "forward_sources": (forward_sources, SOURCES_SQL),
    "issue_table": (issue_table, ISSUE_SQL),
    "new_forwards": (new_forwards, NEW_FORWARDS_SQL),
    "merge_edge_lists": (merge_edge_lists, MERGE_LISTS_SQL),
    "merge_candidates": (merge_candidates, f"WITH {_CANDIDATES_SQL} SELECT * FROM cand"),
    "minus_processed": (minus_processed, MINUS_SQL),
    "frontier_order": (frontier_order, FRONTIER_SQL),
    "run_progress": (run_progress, PROGRESS_SQL),
    "exploration_priority": (exploration_priority, PRIORITY_SQL),
    "explorable": (explorable, EXPLORABLE_SQL),
    "lang_priority": (lang_priority, LANG_SQL),
    "snowball": (snowball, SNOWBALL_SQL),
    "crawl_order": (crawl_order, CRAWL_SQL),
}
