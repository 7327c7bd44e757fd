"""Benchmark decontamination by a distributed positional inverted index.

The index holds postings (term, document, position) of the corpus for the terms that
benchmark items use. A window of an item is looked up from its rarest terms: their
postings, shifted by the term's place in the window, have to meet at the same start; what
is left is confirmed on the postings of all terms. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanlake.llm.rows import row_digest
from chanlake.session import materialised, scratch

WINDOW = 10
RAREST = 2  # lists intersected before the rest of a window is confirmed
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | Column) -> Column:
    """Words after lower-casing A-Z alone; null has none. Other letters keep their case, so
    the fast lower() serves texts of ASCII only."""
    text = F.col(text) if isinstance(text, str) else text
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, _GAP), ""), F.array().cast("array<string>"))


def windows_of(items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``window_id, terms`` and ``window_id, item_id``.

    A shorter item is one window; items without words or without an id have none. The id is a
    64-bit hash of the terms: small enough for the joins that spare the index a shuffle.
    """
    worded = items.filter("item_id IS NOT NULL").select("item_id", words_of("text").alias("_words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - width, F.lit(0)))
    rows = (
        worded.filter(F.size("_words") > 0)
        .withColumn("_start", F.explode(starts))
        .select("item_id", F.slice("_words", F.col("_start") + 1, width).alias("terms"))
        .distinct()
        .withColumn("window_id", F.xxhash64(F.array_join("terms", " ")))
    )
    return rows.select("window_id", "terms").distinct(), rows.select("window_id", "item_id")


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``term_id, doc, pos`` of all words of ``doc, _words`` that are in ``term, term_id``."""
    return (
        docs.select("doc", F.posexplode("_words").alias("pos", "term"))
        .join(vocabulary, "term")
        .select("term_id", "doc", "pos")
    )


def build_index(docs: DataFrame, items: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The stored postings of ``docs`` for all terms of ``items``, with the terms."""
    terms = items.select(F.explode(words_of("text")).alias("term")).distinct()
    vocabulary = terms.withColumn("term_id", F.xxhash64("term"))
    worded = docs.select(F.col(id_column).alias("doc"), words_of("text").alias("_words"))
    return materialised(postings(worded, vocabulary), "postings")


def _ranked_terms(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``window_id, offset, term_id, df, rank``: rank 1 is the rarest; ties by offset.

    Windows with a term that the corpus lacks cannot occur and are left out.
    """
    df = index.groupBy("term_id").agg(F.count("*").alias("df"))
    placed = windows.select("window_id", F.posexplode("terms").alias("offset", "term")).select(
        "window_id", "offset", F.xxhash64("term").alias("term_id")
    )
    all_terms = Window.partitionBy("window_id")
    ranked = (
        placed.join(df, "term_id", "left")
        .withColumn("_absent", F.max(F.col("df").isNull()).over(all_terms))
        .filter(~F.col("_absent"))
        .withColumn("rank", F.row_number().over(all_terms.orderBy("df", "offset")))
    )
    return ranked.drop("_absent")


def phrase_matches(index: DataFrame, windows: DataFrame, rarest: int = RAREST) -> DataFrame:
    """``doc, start, window_id, length`` of every exact occurrence of every window."""
    ranked = materialised(_ranked_terms(windows, index), "terms")
    lengths = ranked.groupBy("window_id").agg(F.count("*").cast("int").alias("length"))
    found = None
    for rank in range(1, rarest + 1):
        # the next list is read once for all windows; a posting meets candidates at its place
        own = ranked.filter(F.col("rank") == rank).select("window_id", "term_id", "offset")
        if found is None:
            found = index.join(own, "term_id").select("doc", (F.col("pos") - F.col("offset")).alias("start"), "window_id")
            found = found.filter("start >= 0")
            continue
        listed = index.join(own.select("term_id").distinct(), "term_id", "left_semi")
        expected = found.join(own, "window_id", "left").withColumn("pos", F.col("start") + F.coalesce("offset", F.lit(0)))
        # windows of fewer terms have no list of this rank: they pass
        passed = expected.filter("term_id IS NULL")
        met = expected.filter("term_id IS NOT NULL").join(listed, ["term_id", "doc", "pos"], "left_semi")
        found = met.unionByName(passed).select("doc", "start", "window_id")
    candidates = materialised(found, "candidates")
    return _confirmed(index, candidates, ranked).join(lengths, "window_id").select("doc", "start", "window_id", "length")


def _confirmed(index: DataFrame, candidates: DataFrame, ranked: DataFrame) -> DataFrame:
    """Candidates whose every term stands at its place, on the postings of their documents."""
    # candidates grow with the corpus: they are never broadcast, whatever their size here
    near = index.join(candidates.select("doc").distinct().hint("merge"), "doc", "left_semi")
    expected = candidates.join(ranked.select("window_id", "offset", "term_id"), "window_id").withColumn(
        "pos", F.col("start") + F.col("offset")
    )
    checked = expected.join(near.withColumn("_hit", F.lit(1)), ["doc", "pos", "term_id"], "left")
    return (
        checked.groupBy("doc", "start", "window_id")
        .agg(F.count("*").alias("_n"), F.count("_hit").alias("_hits"))
        .filter("_n = _hits")
        .drop("_n", "_hits")
    )


def proximity_matches(index: DataFrame, windows: DataFrame, slop: int, rarest: int = 3) -> DataFrame:
    """``doc, start, window_id`` where the rarest terms of a window stand near each other.

    Each of the ``rarest`` terms has to be at most ``slop`` words from its exact place
    relative to the rarest one; ``slop`` 0 asks for the exact places of those terms only.
    """
    ranked = _ranked_terms(windows, index).filter(F.col("rank") <= rarest)
    anchors = index.join(ranked.filter("rank = 1"), "term_id").select(
        "doc", (F.col("pos") - F.col("offset")).alias("start"), "window_id"
    )
    wanted = ranked.filter("rank > 1").select("window_id", "offset", "term_id")
    counts = ranked.groupBy("window_id").agg((F.count("*") - 1).alias("_wanted"))
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    near = (
        anchors.join(wanted, "window_id")
        .withColumn("_shift", shifts)
        .withColumn("pos", F.col("start") + F.col("offset") + F.col("_shift"))
        .join(index.withColumn("_hit", F.lit(1)), ["doc", "pos", "term_id"])
        .groupBy("doc", "start", "window_id")
        .agg(F.count_distinct("offset").alias("_hits"))
    )
    joined = anchors.join(counts, "window_id").join(near, ["doc", "start", "window_id"], "left")
    return joined.filter(F.coalesce("_hits", F.lit(0)) == F.col("_wanted")).select("doc", "start", "window_id")


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, id_column: str = "doc_id") -> DataFrame:
    """``id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    ``n_hit``: words inside any occurrence of a window, each once. Null and wordless texts
    have no words and no hits; without items nothing is hit. Rows are told apart by a digest of
    id and text, so ids may be absent or come twice, and equal rows get equal results. The
    digest of items is of the sorted ids as strings, comma-joined.
    """
    with scratch(docs.sparkSession):
        docs = docs.select(F.col(id_column).alias("_id"), "text").withColumn("_doc", row_digest("_id", "text"))
        index = build_index(docs, items, "_doc")
        windows, of_items = windows_of(items, width)
        matches = materialised(phrase_matches(index, windows), "matches")
        before = Window.partitionBy("doc").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
        end = F.col("start") + F.col("length")
        fresh = end - F.greatest("start", F.coalesce("_reached", F.col("start")))
        hits = (
            matches.select("doc", "start", "length")
            .distinct()
            .withColumn("_reached", F.max(end).over(before))
            .groupBy("doc")
            .agg(F.sum(F.greatest(fresh, F.lit(0))).cast("bigint").alias("n_hit"))
        )
        found_items = (
            matches.select("doc", "window_id")
            .distinct()
            .join(of_items, "window_id")
            .groupBy("doc")
            .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("_items"))
        )
        none = F.array().cast("array<string>")
        found = hits.join(found_items, "doc", "left")
        words = docs.select("_id", F.col("_doc").alias("doc"), F.size(words_of("text")).cast("bigint").alias("n_words"))
        items_found = F.coalesce("_items", none)
        result = words.join(found, "doc", "left").select(
            F.col("_id").alias(id_column),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.size(items_found).cast("bigint").alias("n_items"),
            F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
        return materialised(result, "contamination", keep=True)
