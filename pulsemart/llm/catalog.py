"""Registered queries of the training-data operators, and their SQL.

Each ``opN_*`` query applies its operator with production parameters to its
whole table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.llm import (
    chat, decontaminate, lines, lm, merkle, mixing, neardup, paragraphs, phrases, quality, sharding, suffixes, toxicity,
)
from pulsemart.llm.common import documents, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP1_SQL = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
                lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS win
  FROM b WHERE len(w) > 0
), dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS win
  FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n
), h AS (
  SELECT doc_id, p, n, win FROM dw SEMI JOIN bw USING (n, win)
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM h JOIN bw USING (n, win) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir)).drop("text")


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (
  SELECT doc_id, t, string_split(t, chr(10)) AS ls,
         list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM d
), i AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM f
), g AS (
  SELECT doc_id, p, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS tri
  FROM i WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), h AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, tri) AS k FROM g WHERE tri IS NOT NULL
), r AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM h WHERE k >= 2) GROUP BY doc_id
), b AS (
  SELECT f.doc_id, t, ls, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(list_filter(ls, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
           - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
         coalesce(r.n_repeat_words, 0) AS n_repeat_words
  FROM f LEFT JOIN r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND word_chars BETWEEN 2 * n_words AND 14 * n_words
       AND 10 * n_symbols <= n_words
       AND 10 * n_dup_lines <= 3 * len(ls)
       AND 10 * len(list_filter(ls, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) <= 9 * len(ls)
       AND 10 * len(list_filter(ls, lambda x: regexp_matches(rtrim(x, ' '), '([.][.][.]|…)$'))) <= 3 * len(ls)
       AND 4 * length(regexp_replace(t, '[^0-9]+', '', 'g')) <= word_chars
       AND 10 * len(list_filter(w, lambda x: regexp_matches(x, '\\p{L}'))) >= 7 * len(w) AS kept
FROM b
"""


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(documents(spark, sf_dir))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), width=3, percent=85).drop("text_hash", "component")


OP4_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END) AS g
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS node, doc_id AS other FROM d
  UNION
  SELECT r.node, e.b FROM r JOIN e ON e.a = r.other
), c AS (
  SELECT node, min(other) AS component_id FROM r GROUP BY node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d JOIN c ON c.node = d.doc_id LEFT JOIN n USING (doc_id)
"""


N_SHARDS = 24


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_by_bytes(documents(spark, sf_dir), N_SHARDS)
    return out.select(
        "doc_id", "size", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["length"]))
    return out.withColumn("mask", F.array_join(spans, ","))


OP6_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS role,
         coalesce(text, '') AS text
  FROM conversations
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS n FROM t
), h AS (
  SELECT conv_id, (n - 1) // 256 AS part, n, role, text, false AS again FROM n
  UNION ALL
  SELECT n.conv_id, p.part, n.n, role, text, true
  FROM n JOIN (SELECT DISTINCT conv_id, (n - 1) // 256 AS part FROM n WHERE n > 256) p ON n.conv_id IS NOT DISTINCT FROM p.conv_id
  WHERE n.n <= 256 AND role = 'system'
), s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
p AS (
  SELECT h.conv_id, s.speaker, part, n, again, role = s.speaker AS own,
         '<|im_start|>' || CASE WHEN role = s.speaker THEN 'assistant' WHEN role = 'system' THEN role
           ELSE 'user name=' || replace(role, '<|', '<' || chr(8203) || '|') END || chr(10) AS head,
         replace(text, '<|', '<' || chr(8203) || '|') || '<|im_end|>' AS body
  FROM h JOIN s ON h.conv_id IS NOT DISTINCT FROM s.conv_id
), m AS (
  SELECT *, (sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY n)
             - length(body) - 1)::BIGINT AS start
  FROM p
)
SELECT conv_id, speaker, part, count(*) FILTER (NOT again) AS n_turns, count(*) FILTER (again) AS n_context,
       string_agg(head || body || chr(10), '' ORDER BY n) AS rendered,
       coalesce(string_agg(start || ':' || length(body), ',' ORDER BY n) FILTER (own), '') AS mask
FROM m GROUP BY conv_id, speaker, part
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP7_SQL = """
WITH d AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, 2 * source_size AS bound, [3, 1, 2][((rank - 1) % 3 + 1)::INT] AS weight FROM s
), l AS (
  SELECT *, ((SELECT sum(source_size) FROM s) * 150 / 100.0::DOUBLE
             - coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER o AS turn
  FROM w WINDOW o AS (ORDER BY bound / weight, rank)
), t AS (
  SELECT source, source_size, least(bound::DOUBLE, coalesce(weight * (
    SELECT first(level ORDER BY turn) FROM l WHERE bound > weight * level), bound::DOUBLE)) AS target
  FROM l
), y AS (
  SELECT *, length(bin(size)) AS k FROM d
), v AS (
  SELECT y.source, k, sum(size)::BIGINT AS words, any_value(t.target) AS target, any_value(t.source_size) AS source_size
  FROM y JOIN t ON y.source IS NOT DISTINCT FROM t.source GROUP BY y.source, k
), x AS (
  SELECT *, CASE WHEN sum(k * words) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > 0 THEN
      (target - 2 * coalesce(sum(words) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(k * words) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) ELSE 0 END AS factor
  FROM v WINDOW o AS (PARTITION BY source ORDER BY k DESC)
), e AS (
  SELECT *, least(2.0::DOUBLE, greatest(0.0::DOUBLE,
    coalesce(arg_max(factor, k) FILTER (factor * k <= 2) OVER (PARTITION BY source), 2.0::DOUBLE) * k)) AS rate
  FROM x
), g AS (
  SELECT *, floor(rate)::INT AS whole, rate - floor(rate) AS p,
         target - sum(floor(rate)::BIGINT * words) OVER (PARTITION BY source) AS wanted
  FROM e
), r AS (
  SELECT y.doc_id, y.size, g.source, g.source_size, g.target, whole, p, wanted,
         (('0x' || substr(md5(y.doc_id::VARCHAR), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM y JOIN g ON y.source IS NOT DISTINCT FROM g.source AND y.k = g.k
), q AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM r
), c AS (
  SELECT *, p > 0 AND coalesce(sum(size) OVER (
      PARTITION BY source, p > 0 ORDER BY q, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + size / 2 <= wanted AS picked
  FROM q
)
SELECT doc_id, size, source_size, target, ((whole + picked::INT) * size)::BIGINT AS taken FROM c
"""


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(documents(spark, sf_dir)).drop("text_hash")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


OP9_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM k
  WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, f.keeper IS NOT NULL AND k.doc_id <> f.keeper AS dropped
  FROM k LEFT JOIN frequent f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return out.drop("text_hash").withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.suffix_dedup(documents(spark, sf_dir))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


OP11_SQL = """
WITH d AS (
  SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents
), w AS (
  SELECT doc_id, unnest(range(0, n_bytes - 49)) AS p,
         unnest(list_transform(range(0, n_bytes - 49), lambda i: substr(h, 2 * i + 1, 100))) AS win
  FROM d WHERE n_bytes >= 50
), m AS (
  SELECT win, min(doc_id) AS least FROM w GROUP BY win HAVING min(doc_id) < max(doc_id)
), f AS (
  SELECT doc_id, p FROM w JOIN m USING (win) WHERE least < doc_id
), i AS (
  SELECT *, p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, -1) AS head FROM f
), g AS (
  SELECT *, sum(head::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM i
), s AS (
  SELECT doc_id, span, min(p) AS a, max(p) + 50 AS z FROM g GROUP BY doc_id, span
), k AS (
  SELECT d.doc_id, h, s.a, coalesce(lag(s.z) OVER (PARTITION BY d.doc_id ORDER BY s.a), 0) AS from_, s.z, n_bytes
  FROM d JOIN s USING (doc_id)
), r AS (
  SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a)
           || substr(any_value(h), 2 * max(z) + 1) AS kept
  FROM k GROUP BY doc_id
)
SELECT d.doc_id, d.n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, d.h))) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(documents(spark, sf_dir)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


OP12_SQL = """
WITH RECURSIVE e AS (
  SELECT doc_id, source,
         coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
           || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
           || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
         coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS body,
         coalesce(strlen(text)::VARCHAR || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) AS crc
  FROM documents
), leaf AS (
  SELECT doc_id, source, sha256(head || body) AS node, CASE WHEN crc % 5 = 0 THEN sha256(head || low) ELSE sha256(head || body) END AS seen,
         (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::BIGINT AS pos, count(*) OVER (PARTITION BY source)::BIGINT AS n
  FROM e
), up AS (
  SELECT source, 0 AS lvl, pos, n, node FROM leaf
  UNION ALL
  SELECT source, lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY source, lvl, pos // 16, n
), sub AS (
  SELECT source, node, (row_number() OVER (ORDER BY source NULLS FIRST) - 1)::BIGINT AS pos, count(*) OVER ()::BIGINT AS n
  FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, n, node FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 16, n
), a AS (
  SELECT source, lvl, pos,
         coalesce(string_agg(node, '') OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM up WHERE n > 1 WINDOW o AS (PARTITION BY source, lvl, pos // 16 ORDER BY pos)
), b AS (
  SELECT lvl, pos,
         coalesce(string_agg(node, '') OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(node, '') OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM top WHERE n > 1 WINDOW o AS (PARTITION BY lvl, pos // 16 ORDER BY pos)
), p AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY tree, lvl) AS step, l, r FROM (
    SELECT leaf.doc_id, 1 AS tree, a.lvl, a.l, a.r
    FROM leaf JOIN a ON leaf.source IS NOT DISTINCT FROM a.source AND a.pos = leaf.pos // (1::BIGINT << (4 * a.lvl))
    UNION ALL
    SELECT leaf.doc_id, 2, b.lvl, b.l, b.r
    FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source JOIN b ON b.pos = sub.pos // (1::BIGINT << (4 * b.lvl)))
), fold AS (
  SELECT doc_id, 0::BIGINT AS step, seen AS node FROM leaf
  UNION ALL
  SELECT fold.doc_id, p.step, sha256(l || node || r) FROM fold JOIN p ON p.doc_id = fold.doc_id AND p.step = fold.step + 1
), proof AS (
  SELECT doc_id, max(step) AS steps, string_agg(l || r, '' ORDER BY step) AS s FROM p GROUP BY doc_id
)
SELECT leaf.doc_id, leaf.node AS leaf, sub.node AS subroot, root.node AS root, sha256(coalesce(s, '')) AS proof_sha256,
       fold.node AS folded_root, fold.node = root.node AS verified
FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source CROSS JOIN (SELECT node FROM top WHERE n = 1) root
LEFT JOIN proof USING (doc_id) JOIN fold ON fold.doc_id = leaf.doc_id AND fold.step = coalesce(steps, 0)
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


OP13_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')), '[\\x20\\x09]+'), lambda x: x <> '') AS w
  FROM documents
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100
), t AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang
), c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k >= 2
), s AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, n, (1000 * c.a * n) // (x.f * y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 :], ' ') JOIN t ON t.lang = c.lang
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), i AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, unnest(list_transform(range(1, k - z + 2), lambda j: array_to_string(string_split(phrase, ' ')[j : j + z - 1], ' '))) AS phrase
    FROM f, (SELECT unnest(range(2, 5)) AS z) WHERE k > z) GROUP BY lang, phrase
), r AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM r WHERE rank <= 2000
"""


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_sharding": op5_sharding,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_mixing": op7_mixing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_collocations": op13_collocations,
}

LLM_ORACLE: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op2_quality_rules": OP2_SQL,
    "op4_minhash_near_dedup": OP4_SQL,
    "op6_chat_formatting": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_suffix_dedup": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
