"""The channel graph: edges, neighbours, priorities, exploration order."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chanlake.functions.dates import days_since
from chanlake.functions.nested import matching_chat, other_chats
from chanlake.operators.neighbours import PAGE_ROWS, depth_for, in_pages
from chanlake.operators.skew import global_rank
from chanlake.session import BucketedStage, materialised, scratch, settings

# Scoring constants (fixed values).
PRIVATE_PRIORITY = 10_000_000
SPAM_UPDATES_PER_PARTICIPANT_DAY = 0.1
DEFAULT_LANGUAGE_STEP = 100
LANGUAGE_STEPS = {
    "EN": 2,
    "FR": 1,
    "ES": 1,
    "DE": 1,
    "EL": 1,
    "IT": 1,
    "PL": 1,
    "RO": 1,
}

FORWARD = "forward"
RECOMMEND = "recommend"
LINKED = "linked"


# --- edges ---------------------------------------------------------------------------


def _tagged(targets: Column, kind: str) -> Column:
    edges = F.transform(targets, lambda v: F.struct(v.alias("dst"), F.lit(kind).alias("kind")))
    return F.coalesce(edges, F.array().cast("array<struct<dst:string,kind:string>>"))


def channel_edges(docs: DataFrame) -> DataFrame:
    """Distinct ``src, dst, kind`` edges held in channel documents."""
    source = F.col("full_chat.id").alias("src")
    lists = {
        FORWARD: F.col("forwards_from"),
        RECOMMEND: F.col("recommended_channels"),
        LINKED: other_chats(F.col("chats"), F.col("full_chat.id")),
    }
    # One scan of the documents: the three lists are tagged and exploded together.
    tagged = F.concat(*(_tagged(values, kind) for kind, values in lists.items()))
    return docs.select(source, F.inline(tagged)).distinct()


def forward_pairs(messages: DataFrame) -> DataFrame:
    """Distinct ``channel_id, source_id`` pairs from flat messages."""
    return (
        messages.filter((F.col("fwd_from_type") == "PeerChannel") & F.col("fwd_from_id").isNotNull())
        .select("channel_id", F.col("fwd_from_id").alias("source_id"))
        .distinct()
    )


def adjacency(
    pairs: DataFrame, key: str, value: str, out: str, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """``key, depth, page, out``: the sorted sets of neighbours, in pages.

    ``page`` is a range of hashes, the one that starts with these ``depth`` bits, so a row says what
    it holds whatever the size of the set; a set of up to ``page_rows`` members is the one page of
    depth 0. Stored sets that grow: ``chanlake.operators.neighbours``.
    """
    distinct = pairs.select(key, value).distinct()
    sizes = distinct.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > page_rows)
    depths = sizes.select(key, depth_for(F.col("_n"), page_rows).alias("depth"))
    return in_pages(distinct, depths, key, value).withColumnRenamed("members", out).withColumn("page", F.col("page").cast("int"))


def forwards_from(messages: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """Per channel the set of channels it forwarded from, joined with the saved set.

    ``saved`` has ``channel_id, source_id`` rows.
    """
    pairs = forward_pairs(messages)
    if saved is not None:
        pairs = pairs.unionByName(saved.select("channel_id", "source_id"))
    return adjacency(pairs, "channel_id", "source_id", "forwards_from")


def recommended_by(edges: DataFrame) -> DataFrame:
    """Per channel the set of channels that recommend it."""
    pairs = edges.filter(F.col("kind") == RECOMMEND).select(
        F.col("dst").alias("channel_id"), F.col("src").alias("source_id")
    )
    return adjacency(pairs, "channel_id", "source_id", "recommended_by")


def last_forward_per_source(view: DataFrame) -> DataFrame:
    """Per channel and forwarded channel the last message, in file then id order.

    ``view`` is the forward view with ``channel_id`` and ``file_path``.
    """
    source = F.col("fwd_from.from_id.channel_id")
    return (
        view.filter(source.isNotNull())
        .groupBy("channel_id", source.alias("source_id"))
        .agg(
            F.max_by(
                F.struct("id", F.col("reply_to.reply_to_msg_id").alias("reply_to")),
                F.struct("file_path", "id"),
            ).alias("_last")
        )
        .select("channel_id", "source_id", "_last.id", "_last.reply_to")
    )


def forward_sources(pairs: DataFrame, anon_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hashed forward sources with their originals, and the pairs no map row explains."""
    inverse = anon_map.groupBy("hash").agg(F.min("original").alias("original_id"))
    known = inverse.withColumnRenamed("hash", "source_id")
    # equal hashes side by side are stored once; apart, their 64 characters are stored for each pair
    joined = materialised(pairs.join(known, "source_id", "left").sortWithinPartitions("source_id"), "sources")
    missing = F.col("original_id").isNull()
    return joined.filter(~missing), joined.filter(missing).select(*pairs.columns)


def issue_table(
    pairs: DataFrame, channels: DataFrame, channel: str = "channel_id", target: str = "source_id"
) -> DataFrame:
    """Links to channels without a document, to be retried."""
    known = channels.select(F.col("id").alias(target)).distinct()
    return pairs.select(channel, target).distinct().join(known, target, "left_anti")


def edge_channel_lookup(edges: DataFrame, channels: DataFrame) -> DataFrame:
    """Edges with the target's channel row; ``has_doc`` is false for private targets."""
    target = channels.withColumnRenamed("id", "dst").withColumn("has_doc", F.lit(True))
    joined = edges.join(target, "dst", "left")
    return joined.withColumn("has_doc", F.coalesce("has_doc", F.lit(False)))


def merge_edge_lists(old: Column, new: Column) -> Column:
    """Union of two saved neighbour sets, sorted."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(old, empty), F.coalesce(new, empty)))


def new_forwards(chunk: DataFrame, known: DataFrame) -> DataFrame:
    """Forward pairs of a new chunk that are not known yet."""
    keys = ["channel_id", "source_id"]
    return chunk.select(*keys).distinct().join(known.select(*keys), keys, "left_anti")


# --- priorities ----------------------------------------------------------------------


def lang_priority(language: Column, steps: dict[str, int] = LANGUAGE_STEPS) -> Column:
    """Increment of a channel by its language; unknown or inconclusive ones get 100."""
    table = F.create_map(*(F.lit(x) for pair in steps.items() for x in pair))
    return F.coalesce(F.try_element_at(table, language), F.lit(DEFAULT_LANGUAGE_STEP))


def looks_like_spam(pts: Column, participants: Column, created: Column, now: Column) -> Column:
    """More than one update in ten days per participant over the channel's life."""
    rate = pts / (1 + participants * (1 + days_since(created, now)))
    return rate > SPAM_UPDATES_PER_PARTICIPANT_DAY


def exploration_priority(
    has_doc: Column,
    spam: Column,
    language: Column,
    parent: Column,
    private_priority: int = PRIVATE_PRIORITY,
) -> Column:
    """Private last, spam-like just before, others after their parent by language.

    Null for a channel whose counters are unknown, so that it can be set aside.
    """
    return (
        F.when(~has_doc, F.lit(private_priority))
        .when(spam.isNull(), F.lit(None).cast("int"))
        .when(spam, F.lit(private_priority - 1))
        .otherwise(parent + lang_priority(language))
    ).cast("bigint")


def matching_doc_fields(docs: DataFrame) -> DataFrame:
    """The fields of a document that scoring needs, by channel."""
    chat = matching_chat(F.col("chats"), F.col("full_chat.id"))
    return docs.select(
        F.col("full_chat.id").alias("id"),
        F.col("full_chat.pts").alias("pts"),
        F.col("full_chat.participants_count").alias("participants_count"),
        F.try_to_timestamp(chat["date"]).alias("date"),
        chat["title"].alias("title"),
        F.col("full_chat.about").alias("about"),
    )


def merge_candidates(forwarded: DataFrame, recommended: DataFrame) -> DataFrame:
    """One priority per candidate; a recommendation overrides a forward."""
    ranked = forwarded.withColumn("_rank", F.lit(0)).unionByName(
        recommended.withColumn("_rank", F.lit(1))
    )
    return ranked.groupBy("channel_id").agg(
        F.max_by("priority", F.struct("_rank", -F.col("priority"))).alias("priority")
    )


def minus_processed(candidates: DataFrame, processed: DataFrame) -> DataFrame:
    return candidates.join(processed.select("channel_id"), "channel_id", "left_anti")


def frontier_order(frontier: DataFrame, limit: int | None = None) -> DataFrame:
    """Channels in the order they would be explored, each once at its best priority.

    With a limit Spark keeps only the first rows of each task.
    """
    unique = frontier.groupBy("channel_id").agg(F.min("priority").alias("priority"))
    ordered = unique.orderBy("priority", "channel_id")
    return ordered if limit is None else ordered.limit(limit)


def run_progress(channels: DataFrame, processed: DataFrame) -> DataFrame:
    """How many channels are done and how many remain."""
    done = processed.select("channel_id").distinct().withColumn("_done", F.lit(True))
    marked = channels.select("channel_id").distinct().join(done, "channel_id", "left")
    return marked.agg(
        F.count_if(F.col("_done")).alias("processed"),
        F.count_if(F.col("_done").isNull()).alias("remaining"),
    )


# --- snowball ------------------------------------------------------------------------

EDGES_PER_BUCKET = 1_000_000
PAGE_EDGES = 100_000  # edges of one source that may lie in one bucket


def scored_targets(edges: DataFrame, nodes: DataFrame, private_priority: int) -> DataFrame:
    """Edges with what their target adds to a parent's priority.

    ``nodes`` has ``channel_id, has_doc, spam, language``. ``fixed`` is the constant
    priority of a spam-like target. Private targets can never be explored, and so
    their edges are left out.
    """
    info = nodes.select(
        F.col("channel_id").alias("dst"),
        F.when(F.col("spam"), F.lit(private_priority - 1)).cast("bigint").alias("fixed"),
        lang_priority(F.col("language")).cast("bigint").alias("step"),
    ).filter(nodes["has_doc"] & nodes["spam"].isNotNull())
    distinct = edges.select("src", "dst").distinct()
    return distinct.join(info, "dst")


class Adjacency:
    """Edges written once, in buckets of (source, page): a round moves its frontier, no edge.

    A source has one page for each ``page`` edges, and an edge its page by a digest of its
    target, so that the edges of a hot source lie in many buckets.
    """

    def __init__(self, edges: DataFrame, name: str, buckets: int, page: int = PAGE_EDGES):
        degrees = edges.groupBy("src").agg(F.count("*").alias("n")).filter(F.col("n") > page)
        self.hot = materialised(degrees.select("src", F.ceil(F.col("n") / page).alias("pages")), f"{name}-hot")
        own = F.pmod(F.xxhash64("dst"), F.coalesce("pages", F.lit(1))).alias("page")
        paged = edges.join(self.hot, "src", "left").select(*edges.columns, own)
        self.stage = BucketedStage(edges.sparkSession, name, buckets, ["src", "page"])
        self.stage.append(paged.repartition(buckets, "src", "page"))

    def of(self, frontier: DataFrame) -> DataFrame:
        """The edges of the channels in ``frontier``, with its columns."""
        pages = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("pages", F.lit(1)) - 1))
        asked = frontier.withColumnRenamed("channel_id", "src").join(self.hot, "src", "left")
        return asked.withColumn("page", pages).drop("pages").join(self.stage.read(), ["src", "page"])

    def drop(self) -> None:
        self.stage.drop()


def improved(
    state: DataFrame, links: Adjacency, targets: Adjacency, number: int, private_priority: int
) -> DataFrame:
    """What gets better by round ``number`` of the state: ``channel_id, priority, round``."""
    changed = state.filter(F.col("round") == number).select("channel_id", "priority")
    # Priority from which a channel's neighbours count: its own, or that of a channel it is
    # linked from.
    through_links = links.of(changed).select(F.col("dst").alias("channel_id"), "priority")
    best = F.min("priority").alias("priority")
    sources = changed.unionByName(through_links).groupBy("channel_id").agg(best)
    reached = (
        targets.of(sources)
        .select(
            F.col("dst").alias("channel_id"),
            F.coalesce("fixed", F.col("priority") + F.col("step")).alias("priority"),
        )
        .filter(F.col("priority") < private_priority)
        .groupBy("channel_id")
        .agg(best)
    )
    known = state.groupBy("channel_id").agg(F.min("priority").alias("_known"))
    better = F.col("_known").isNull() | (F.col("priority") < F.col("_known"))
    return (
        reached.join(known, "channel_id", "left")
        .filter(better)
        .select("channel_id", "priority", F.lit(number + 1).alias("round"))
    )


def snowball(
    edges: DataFrame,
    nodes: DataFrame,
    seeds: DataFrame,
    private_priority: int = PRIVATE_PRIORITY,
) -> DataFrame:
    """``channel_id, priority`` of every channel reached from the seeds.

    The priority is the one a channel has when it is taken from a queue ordered by
    (priority, id). As increments are positive and depend on the target only, that is
    a shortest distance: each round joins the channels whose priority got better with
    their edges and keeps the minimum per target, until nothing improves. A channel's
    linked chats (assumed to be linked both ways) are visited along with it unless they
    are private, and what they point to counts from its priority.

    Edges and state lie in buckets; a round appends what got better to the state and
    shuffles nothing but its frontier and what that reaches.
    """
    spark = edges.sparkSession
    fetched = nodes.filter(F.col("has_doc") & F.col("spam").isNotNull())
    links = edges.filter(F.col("kind") == LINKED).select("src", "dst").distinct()
    start = fetched.join(seeds.select("channel_id").distinct(), "channel_id", "left_semi").select(
        "channel_id",
        exploration_priority(
            F.lit(True), F.col("spam"), F.col("language"), F.lit(0), private_priority
        ).cast("bigint").alias("priority"),
        F.lit(0).alias("round"),
    )
    with ExitStack() as cleaning:
        cleaning.enter_context(scratch(spark))
        links = materialised(
            links.join(fetched.select(F.col("channel_id").alias("dst")), "dst", "left_semi"), "links"
        )
        targets = materialised(
            scored_targets(edges.filter(F.col("kind") != LINKED), nodes, private_priority), "targets"
        )
        buckets = 1 + targets.count() // EDGES_PER_BUCKET
        cleaning.enter_context(settings(spark, {"spark.sql.shuffle.partitions": str(buckets)}))
        state = BucketedStage(spark, "snowball", buckets, ["channel_id"], ("round",))
        cleaning.callback(state.drop)
        linked, pointed = (Adjacency(rows, name, buckets) for rows, name in ((links, "links"), (targets, "targets")))
        cleaning.callback(linked.drop)
        cleaning.callback(pointed.drop)
        state.append(start)
        more, number = not state.read().isEmpty(), 0
        while more:
            # The write itself counts what got better: no further job decides on another round.
            watch = Observation()
            found = improved(state.read(), linked, pointed, number, private_priority)
            state.append(found.observe(watch, F.count("*").alias("better")))
            more, number = watch.get["better"] > 0, number + 1
        best = state.read().groupBy("channel_id").agg(F.min("priority").alias("priority"))
        return materialised(best, "visited", keep=True)


def crawl_order(visited: DataFrame, name: str = "rank") -> DataFrame:
    """The place of each channel in the exploration, from 1."""
    return global_rank(visited, ["priority", "channel_id"], name)
