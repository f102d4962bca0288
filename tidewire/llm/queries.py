"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import conversations, decontamination, lines, mixing, near_duplicates, neighbours, pages, parity_join, phrases, quality, sharding, tokens, toxicity
from tidewire.llm.keys import held_out

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_nnpu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    rows = toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_spaced_seed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS v FROM benchmark),
dp AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS p FROM d)),
bp AS (SELECT item_id, q, v[q] || ' ' || v[q + 1] || ' ' || v[q + 2] || ' ' || v[q + 3] AS g FROM (SELECT item_id, v, unnest(range(1, len(v) - 2)) AS q FROM b)),
diagonals AS (SELECT DISTINCT doc_id, item_id, p - q AS s FROM dp JOIN bp USING (g)),
cells AS (
  SELECT doc_id, item_id, s, q, CAST(w[q + s] = v[q] AS INTEGER) AS same
  FROM (SELECT x.doc_id, x.item_id, s, w, v, unnest(range(greatest(1, 1 - s), least(len(v), len(w) - s) + 1)) AS q FROM diagonals x JOIN d USING (doc_id) JOIN b USING (item_id))),
sums AS (SELECT doc_id, item_id, sum(same) OVER r AS n, count(*) OVER r AS c FROM cells WINDOW r AS (PARTITION BY doc_id, item_id, s ORDER BY q ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
hits AS (SELECT doc_id, item_id, max(n) AS n FROM sums WHERE c = 12 AND n >= 10 GROUP BY ALL),
found AS (SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item, CAST(max(n) AS BIGINT) AS equal_words FROM hits GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, first_item, equal_words FROM documents LEFT JOIN found USING (doc_id)
"""


def op3_line_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return _kept_digest(lines.without_passages(_table(spark, folder, "documents"), within=False))


def line_hashing_within(spark: SparkSession, folder: str) -> DataFrame:
    """As op3, but what a document repeats of itself goes too."""
    return _kept_digest(lines.without_passages(_table(spark, folder, "documents")))


def _kept_digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", F.size("removed").cast("long").alias("n_removed"), F.length("kept_text").cast("long").alias("kept_chars"), F.md5(F.col("kept_text").cast("binary")).alias("kept_md5"))


OP3_SQL = r"""
WITH t AS (SELECT doc_id, text, regexp_extract(text, '^[\x20\x09-\x0D]*') AS lead, regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS g FROM documents),
g AS (SELECT doc_id, generate_subscripts(g, 1) AS i, unnest(g) AS g FROM t),
w AS (SELECT *, translate(regexp_extract(g, '^[^\x20\x09-\x0D]+'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM g),
e AS (SELECT *, CAST(md5(w) < '4' OR contains(g, chr(10)) AS INTEGER) AS last FROM w),
n AS (SELECT *, coalesce(sum(last) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS j FROM e),
u AS (SELECT doc_id, j, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS u FROM n GROUP BY doc_id, j),
p AS (SELECT *, lead(u) OVER o AS v, lead(n) OVER o AS n2 FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY j)),
f AS (SELECT *, doc_id > min(doc_id) OVER (PARTITION BY n, u, v) AS again FROM p WHERE v IS NOT NULL),
r AS (SELECT *, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS run FROM f WHERE again),
s AS (SELECT doc_id, min(j) AS a, max(j) + 1 AS b FROM r GROUP BY doc_id, run HAVING sum(n) + max_by(n2, j) >= 40),
c AS (SELECT doc_id, count(*) AS n_removed FROM s GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(g, '' ORDER BY i) AS kept FROM n WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.doc_id = n.doc_id AND j BETWEEN a AND b) GROUP BY doc_id),
d AS (SELECT t.doc_id, coalesce(n_removed, 0) AS n_removed, CASE WHEN text IS NOT NULL THEN lead || coalesce(kept, '') END AS kept FROM t LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id))
SELECT doc_id, n_removed, length(kept) AS kept_chars, md5(kept) AS kept_md5 FROM d
"""

#: Units as in ``lines``: pairs of pieces, and windows of 40 words inside a piece; parts that touch count together if one of them is inside a piece.
LINE_HASHING_WITHIN_SQL = r"""
WITH t AS (SELECT doc_id, text, regexp_extract(text, '^[\x20\x09-\x0D]*') AS lead, regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS g FROM documents),
g AS (SELECT doc_id, generate_subscripts(g, 1) AS i, unnest(g) AS g FROM t),
w AS (SELECT *, translate(regexp_extract(g, '^[^\x20\x09-\x0D]+'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM g),
e AS (SELECT *, CAST(md5(w) < '4' OR contains(g, chr(10)) AS INTEGER) AS last FROM w),
n AS (SELECT *, coalesce(sum(last) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS j FROM e),
u AS (SELECT doc_id, j, count(*) AS n, min(i) AS i0, list(w ORDER BY i) AS u FROM n GROUP BY doc_id, j),
p AS (SELECT *, lead(u) OVER (PARTITION BY doc_id ORDER BY j) AS v FROM u),
x AS (
  SELECT doc_id, j, i0 AS i, 0 AS inside, array_to_string(u || v, ' ') AS s FROM p WHERE v IS NOT NULL
  UNION ALL SELECT doc_id, j, i, 1, array_to_string(u[i - i0 + 1:i - i0 + 40], ' ') FROM (SELECT *, unnest(range(i0, i0 + n - 39)) AS i FROM p WHERE n >= 40)),
y AS (SELECT *, {'d': doc_id, 'i': min(i) OVER (PARTITION BY doc_id, j, inside, s), 'k': inside} AS place FROM x),
f AS (SELECT *, place > min(place) OVER (PARTITION BY s) AS again FROM y),
r AS (SELECT doc_id, j, j - row_number() OVER (PARTITION BY doc_id ORDER BY j) AS run FROM f WHERE again AND inside = 0),
c AS (SELECT doc_id, min(j) AS a, max(j) + 1 AS b FROM r GROUP BY doc_id, run),
h AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id, j ORDER BY i) <= 40 THEN 0 ELSE 1 END AS fresh FROM f WHERE again AND inside = 1 AND NOT EXISTS (SELECT 1 FROM c WHERE c.doc_id = f.doc_id AND f.j BETWEEN c.a AND c.b)),
o AS (
  SELECT doc_id, min(i) AS a, max(i) + 40 AS b, 1 AS inside FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, j ORDER BY i) AS part FROM h) GROUP BY doc_id, j, part
  UNION ALL SELECT c.doc_id, min(i0), max(i0 + n), 0 FROM c JOIN p ON p.doc_id = c.doc_id AND p.j BETWEEN c.a AND c.b GROUP BY c.doc_id, c.a),
q AS (SELECT *, CASE WHEN a = lag(b) OVER o1 AND (inside = 1 OR lag(inside) OVER o1 = 1) THEN 0 ELSE 1 END AS fresh FROM o WINDOW o1 AS (PARTITION BY doc_id ORDER BY a)),
s AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a) AS part FROM q) GROUP BY doc_id, part HAVING max(b) - min(a) >= 40),
m AS (SELECT doc_id, count(*) AS n_removed FROM s GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(g, '' ORDER BY i) AS kept FROM n WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.doc_id = n.doc_id AND n.i >= s.a AND n.i < s.b) GROUP BY doc_id),
d AS (SELECT t.doc_id, coalesce(n_removed, 0) AS n_removed, CASE WHEN text IS NOT NULL THEN lead || coalesce(kept, '') END AS kept FROM t LEFT JOIN m USING (doc_id) LEFT JOIN k USING (doc_id))
SELECT doc_id, n_removed, length(kept) AS kept_chars, md5(kept) AS kept_md5 FROM d
"""


def op4_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = sharding.shuffled_shards(_table(spark, folder, "documents"), 24)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_crf_main_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = pages.main_text(_table(spark, folder, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_adaptive_dimension_search(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def _components_sql(k: int, p: int, more: str = "") -> str:
    """Only repeated shingles can link two documents; components by the smallest reachable id, along links between different sets."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' '))) END AS g
  FROM d),
k AS (SELECT doc_id, len(g) AS n, md5(array_to_string(list_sort(g), chr(10))) AS h, g FROM s),
c AS (SELECT h, min(doc_id) AS doc_id, any_value(n) AS n, any_value(g) AS g FROM k WHERE n > 0 GROUP BY h),
u AS (SELECT doc_id, n, hash(unnest(g)) AS x FROM c),
l AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM u AS a JOIN u AS b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {p} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {p} * (a.n + b.n - count(*))),
e AS (SELECT p, q FROM l UNION ALL SELECT q, p FROM l),
r(node, low) AS (SELECT doc_id, doc_id FROM c UNION SELECT e.q, r.low FROM r JOIN e ON e.p = r.node WHERE r.low < e.q),
m AS (SELECT node, min(low) AS low FROM r GROUP BY node)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(m.low, k.doc_id) AS component_id{more} FROM k LEFT JOIN c ON c.h = k.h AND k.n > 0 LEFT JOIN m ON m.node = c.doc_id
"""


def op7_odd_sketch_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, folder, "documents"))


OP7_SQL = _components_sql(5, 75, ", coalesce(m.low, k.doc_id) = k.doc_id AS kept")


def op8_two_tier_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    rows = tokens.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op9_systematic_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.systematic_mix(_table(spark, folder, "documents"))
    return taken.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
l AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio, row_number() OVER o AS step,
    CAST((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST)),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (SELECT min_by(level, step) FROM l WHERE level <= ratio)) AS target FROM l),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)), md5(coalesce(CAST(doc_id AS VARCHAR), '~') || '#9#' || size), doc_id, size) AS i
  FROM d),
o AS (SELECT source, list_sum(list_transform(range(1, 7), lambda i: (instr('0123456789abcdef', md5(coalesce('=' || source, '') || '#9')[i]) - 1) / power(16.0, i))) AS offs FROM s)
SELECT doc_id, size, source_size, target,
  CAST(size * CASE WHEN source_size > 0 THEN floor(i * (target / source_size) + offs) - floor((i - 1) * (target / source_size) + offs) ELSE 0 END AS BIGINT) AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source JOIN o ON r.source IS NOT DISTINCT FROM o.source
"""

def op10_fourier_ridge_quality(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_trie_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) AS t(k))),
c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
x AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM c WHERE k > 1 AND f >= 30),
u AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS j FROM x)),
s AS (SELECT u.*, h.f AS l, t.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (h.f + t.f) AS BIGINT) AS score FROM u JOIN c AS h ON h.lang = u.lang AND h.phrase = head JOIN c AS t ON t.lang = u.lang AND t.phrase = tail),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM x)) GROUP BY ALL),
e AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT e.lang, rank, phrase, a, l, r, n, score FROM e JOIN n USING (lang) WHERE rank <= 2000
"""


def op12_lightest_repair(spark: SparkSession, folder: str) -> DataFrame:
    raw = _table(spark, folder, "conversations")
    return _repair_digest(raw, conversations.repair(conversations.damaged(raw)))


def _repair_digest(raw: DataFrame, repaired: conversations.Repair) -> DataFrame:
    """Every original conversation with its report and hash; where no message is left, as an empty one."""
    report, hashes = repaired.report.withColumnRenamed("conv_id", "_a"), conversations.digests(repaired).withColumnRenamed("conv_id", "_b")
    ids = raw.select("conv_id").distinct()
    rows = ids.join(report, F.col("conv_id").eqNullSafe(F.col("_a")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("_b")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: CRC-32 byte by byte, then one row after the other: the best way to each of the four states.
OP12_SQL = r"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
f AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS f FROM raw),
d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) FROM f WHERE f > 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
m AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'B' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'D'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'T' ELSE '' END AS kind, role[1:1] AS c, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (kind = 'B') AS blank, count(*) FILTER (kind = 'D') AS duplicate,
    count(*) FILTER (kind = 'T') AS truncated, count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM m GROUP BY conv_id),
p AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': '', 't': ''} AS e, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS u, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS v FROM g
  UNION ALL
  SELECT conv_id, i,
    CASE WHEN e IS NOT NULL THEN {'c': e.c + 4, 'a': e.a || 'D', 't': e.t} END,
    list_min([CASE WHEN s IS NOT NULL THEN {'c': s.c + 4, 'a': s.a || 'D', 't': s.t} END, CASE WHEN free AND r = 's' AND e IS NOT NULL THEN {'c': e.c + x, 'a': e.a || 'K', 't': e.t || chr(10) || line} END]),
    list_min([CASE WHEN u IS NOT NULL THEN {'c': u.c + 4, 'a': u.a || 'D', 't': u.t} END] || list_transform([e, s, v], lambda q: CASE WHEN free AND q IS NOT NULL THEN CASE WHEN r = 'u' THEN {'c': q.c + x, 'a': q.a || 'K', 't': q.t || chr(10) || line} ELSE {'c': q.c + x + 3, 'a': q.a || 'R', 't': q.t || chr(10) || 'user:' || text} END END)),
    list_min([CASE WHEN v IS NOT NULL THEN {'c': v.c + 4, 'a': v.a || 'D', 't': v.t} END, CASE WHEN free AND u IS NOT NULL THEN CASE WHEN r = 'a' THEN {'c': u.c + x, 'a': u.a || 'K', 't': u.t || chr(10) || line} ELSE {'c': u.c + x + 3, 'a': u.a || 'R', 't': u.t || chr(10) || 'assistant:' || text} END END])
  FROM (
    SELECT q.conv_id, m.i, m.kind IN ('', 'T') AS free, CASE WHEN m.kind = 'T' THEN 3 ELSE 0 END AS x, m.c AS r, m.role || ':' || m.text AS line, m.text, q.e, q.s, q.u2 AS u,
      list_min([q.v, CASE WHEN q.u2 IS NOT NULL THEN {'c': q.u2.c + 3, 'a': q.u2.a || 'I', 't': q.u2.t || chr(10) || 'assistant:'} END]) AS v
    FROM (SELECT *, list_min([u] || list_transform([e, s, v], lambda q: CASE WHEN q IS NOT NULL THEN {'c': q.c + 3, 'a': q.a || 'I', 't': q.t || chr(10) || 'user:'} END)) AS u2 FROM p) q
    JOIN m ON m.conv_id IS NOT DISTINCT FROM q.conv_id AND m.i = q.i + 1)),
z AS (
  SELECT p.conv_id, list_min([e, v, CASE WHEN u IS NOT NULL THEN {'c': u.c + 3, 'a': u.a || 'I', 't': u.t || chr(10) || 'assistant:'} END]) AS best FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.n = p.i)
SELECT r.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) r LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM r.conv_id
"""


def op13_parity_sketch_join(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.jaccard_components(_table(spark, folder, "documents"))


OP13_SQL = _components_sql(4, 85)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_nnpu_toxicity, op2_spaced_seed_decontamination, op3_line_hashing, op4_hypergeometric_shards,
    op5_crf_main_text, op6_adaptive_dimension_search, op7_odd_sketch_near_duplicates,
    op8_two_tier_token_counts, op9_systematic_mixing, op10_fourier_ridge_quality,
    op11_trie_collocations, op12_lightest_repair, op13_parity_sketch_join, line_hashing_within,
)}

ORACLE: dict[str, str] = {
    "op2_spaced_seed_decontamination": OP2_SQL,
    "op3_line_hashing": OP3_SQL,
    "op7_odd_sketch_near_duplicates": OP7_SQL,
    "op9_systematic_mixing": OP9_SQL,
    "op11_trie_collocations": OP11_SQL,
    "op12_lightest_repair": OP12_SQL,
    "op13_parity_sketch_join": OP13_SQL,
    "line_hashing_within": LINE_HASHING_WITHIN_SQL,
}
