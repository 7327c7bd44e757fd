"""Queries of the operators for training data, with the SQL they must equal where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.llm import (
    decontaminate, fim, langid, lm, mixing, neardup, quality, secrets, sharding, suffixes, tokencount, topk, trie,
)
from chanlake.llm.ship import ship
from chanlake.session import configure, work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(ship(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 10) == 0).alias("held_out"))
    model = lm.train(docs.filter(~F.col("held_out")))
    scored = lm.score(docs, model, keep=("held_out",))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold("doc_id", 5) == 0).alias("held_out"))
    model = langid.train(docs.filter(~F.col("held_out")))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratio = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.resample(docs, ratio)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter("id % 50 = 0"), 5)


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.curriculum(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    first = F.array_min("steps").alias("first_step")
    digested = mixed.select("doc_id", "size", "source_size", "target", "taken", first)
    return digested.repartitionByRange("first_step", "doc_id").sortWithinPartitions("first_step", "doc_id")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS o,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
w AS (SELECT *, (place - 1) % 3 AS no, [5.0, 2.0, 1.0][CAST((place - 1) % 3 + 1 AS INT)]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS lim FROM r),
f AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS fair
  FROM w),
u AS (SELECT *, max(CASE WHEN lim > fair * weight THEN fair END) OVER () AS unit FROM f),
t AS (SELECT source, source_size, no, least(lim, coalesce(unit * weight, lim)) AS target FROM u),
p AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
m AS (SELECT p.*, source_size, target, [0.5, 1.0, 1.5][CAST(no + 1 AS INT)]::DOUBLE AS a,
    [1.5, 1.0, 0.5][CAST(no + 1 AS INT)]::DOUBLE AS b, before + size / 2.0::DOUBLE AS first,
    (1.0::DOUBLE * source_size + before) + size / 2.0::DOUBLE AS second
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, least(first / greatest(target, 1e-9), 1.0::DOUBLE) AS share FROM m)
SELECT doc_id, size, source_size, target,
  CAST(size * ((first <= target)::INT + (second <= target)::INT) AS BIGINT) AS taken,
  CASE WHEN first <= target THEN CAST(least(floor(CASE WHEN share > 0 THEN
    2.0::DOUBLE * share / (a + sqrt(a * a + 2.0::DOUBLE * (b - a) * share)) ELSE 0 END * 1000000.0), 999999) AS BIGINT) END AS first_step
FROM x
"""


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS o FROM documents UNION SELECT e.b, r.o FROM r JOIN e ON e.a = r.v),
g AS (SELECT v, min(o) AS component_id FROM r GROUP BY v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN g ON g.v = d.doc_id
"""


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, learn_from=fold("doc_id", 5) != 0)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "occurrence", F.sha2("value", 256).alias("value_sha256"),
                        F.length("value").cast("bigint").alias("n_chars"), "probability", "is_secret")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokencount.count_tokens(docs, tokenizer_path(), work_path(spark, "token-counts"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))


_WORDS_SQL = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP9_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)),
m AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return sharding.shard(docs.withColumn("text_crc32", crc)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digests = {f"{name}_sha256": F.sha2(text.cast("binary"), 256) for name, text in (
        ("output", F.col("output")), ("restored", fim.restore(F.col("output"), F.col("form"))))}
    return made.withColumns(digests).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''),
    '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT *, CAST(len(w) AS BIGINT) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
    ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
      THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


def op12_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return left.select(
        "doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


OP12_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT doc_id, o, substring(x, 2 * o + 1, 1098) AS x
  FROM (SELECT doc_id, x, unnest(range(0, greatest(len(x) // 2 - 49, 0), 500)) AS o FROM d)),
w AS (SELECT doc_id, o + k AS i, substring(x, 2 * k + 1, 100) AS win
  FROM (SELECT doc_id, o, x, unnest(range(0, len(x) // 2 - 49)) AS k FROM c)),
m AS (SELECT win, min(doc_id) AS least FROM w GROUP BY win HAVING min(doc_id) <> max(doc_id)),
r AS (SELECT doc_id, i FROM w JOIN m USING (win) WHERE doc_id > least),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM r),
k AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS no FROM g),
s AS (SELECT doc_id, no, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, no),
e AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since, a, b FROM s),
t AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS n, max(b) AS last FROM s GROUP BY doc_id),
p AS (SELECT doc_id, string_agg(x[2 * since + 1 : 2 * a], '' ORDER BY a) AS kept FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, '') || x[2 * coalesce(last, 0) + 1 :])) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN p USING (doc_id)
"""


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.turns_of(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.with_borrowed_openings(turns))


_CRC32_SQL = (  # of a whole number as text, bit by bit
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda d: "
    "ascii(d)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: "
    "xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
)
OP13_SQL = rf"""
WITH o AS (SELECT conv_id, md5(coalesce(role, '') || chr(31) || coalesce(text, '')) AS t,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, {_CRC32_SQL.format('conv_id')} % 4 AS h FROM o),
r AS (SELECT c.conv_id, 0 AS part, pos, t, words FROM c JOIN o ON o.conv_id = base AND pos <= h
  UNION ALL SELECT conv_id, 1, pos, t, words FROM c JOIN o USING (conv_id) WHERE pos > h),
q AS (SELECT conv_id, row_number() OVER k AS depth, string_agg(t, '') OVER k AS path, words FROM r
  WINDOW k AS (PARTITION BY conv_id ORDER BY part, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a AS (SELECT conv_id, depth, path, words FROM q UNION ALL SELECT conv_id, 0, '', 0 FROM c),
l AS (SELECT conv_id, max(depth) AS last FROM a GROUP BY conv_id),
n AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CASE WHEN depth = last THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
  FROM a JOIN l USING (conv_id) GROUP BY depth, path),
p AS (SELECT n.*, left(path, len(path) - 32) AS up FROM n),
k AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, path)),
s AS (SELECT x.depth, x.path, sum(CASE WHEN y.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((y.n_convs - 1) * y.words) AS saved_tokens
  FROM f x JOIN f y ON y.depth >= x.depth AND left(y.path, len(x.path)) = x.path GROUP BY x.depth, x.path)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n_convs, CAST(f.n_children AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN s USING (depth, path) LEFT JOIN n u ON u.depth = f.depth - 1 AND u.path = left(f.path, greatest(len(f.path) - 32, 0))
"""


ENTRIES = {
    "op2_language": (op2_language, None),
    "op3_quality": (op3_quality, None),
    "op4_topk": (op4_topk, OP4_SQL),
    "op5_mixing": (op5_mixing, OP5_SQL),
    "op6_near_duplicates": (op6_near_duplicates, OP6_SQL),
    "op7_secrets": (op7_secrets, None),
    "op8_token_counts": (op8_token_counts, None),
    "op9_decontamination": (op9_decontamination, OP9_SQL),
    "op10_sharding": (op10_sharding, None),
    "op1_lm_score": (op1_lm_score, None),
    "op11_fill_in_middle": (op11_fill_in_middle, OP11_SQL),
    "op12_repeated_substrings": (op12_repeated_substrings, OP12_SQL),
    "op13_conversation_trie": (op13_conversation_trie, OP13_SQL),
}
