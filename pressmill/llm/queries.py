"""The corpus operators as queries over whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressmill.llm import chat, collocations, decontamination, filter_audit, jaccard_join, kd_search, mixing, packing, pii, quality, sharding, suffix_dedup, toxicity
from pressmill.llm._common import table

#: A conversation whose texts hold what templates use as control strings.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).selectExpr("-7L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", f"r'{CONTROL_TEXT}' as text")
    return chat.digest(given.unionByName(own))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.digest(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(table(spark, sf_dir, "documents"))


def op11_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.digest(table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.digest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pii, op2_mixing, op3_quality, op4_sharding, op5_chat, op6_toxicity, op7_decontamination, op8_suffix_dedup, op9_jaccard_join, op10_packing, op11_kd_search, op12_filter_audit, op13_collocations, pipeline)
}

_OP3 = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT k, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT k, i, x, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z FROM p WINDOW o AS (PARTITION BY k ORDER BY i)),
c AS (SELECT k, i, x, (z IS NOT NULL AND count(*) OVER (PARTITION BY k, x, y, z) > 1)::int AS twice FROM g),
h AS (SELECT k, max(twice) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit, count(*) OVER (PARTITION BY k, x) AS same FROM c),
r AS (SELECT k, sum(hit) AS n_repeat, max(same) AS top FROM h GROUP BY k),
f AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(n_repeat, 0) AS n_repeat_words, coalesce(top, 0) AS top FROM w LEFT JOIN r USING (k))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 15 * n_words OR word_chars < 2 * n_words
    OR word_chars > 25 * n_words OR 100 * n_dup_lines > 30 * n_lines OR top > 0.3 * n_words) AS kept
FROM f
"""

_OP5 = r"""
WITH e AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
x AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(replace(replace(role, '&', '&amp;'), '<', '&lt;')) + length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + 23) AS chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(told) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars FROM x
"""

_OP11 = r"""
WITH v AS (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.k, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM v q JOIN v c ON q.k <> c.k AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
"""

_OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
g AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN w.doc_id > least THEN 16 ELSE 0 END) AS mask
  FROM w LEFT JOIN g ON w.doc_id = g.doc_id),
c AS (SELECT part, mask, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(letter, bit)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step::INT AS step, bits[step] AS bit, list_sum(bits[1:step]) - bits[step] AS before FROM o, range(1, 6) r(step)),
x AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask::INT & (before + bit)::INT = 0 THEN docs ELSE 0 END) AS kept,
    sum(CASE WHEN mask::INT & bit <> 0 AND mask::INT & before::INT = 0 THEN docs ELSE 0 END) AS removed,
    sum(CASE WHEN mask::INT & bit <> 0 AND mask::INT & before::INT <> 0 THEN docs ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN docs ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask::INT & bit <> 0 AND mask::INT & before::INT = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask::INT & bit <> 0 AND mask::INT & before::INT = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM x
"""

_OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, k, generate_subscripts(ps, 1) AS piece, unnest(ps) AS x FROM (SELECT lang, k, string_split_regex(t, '[.,;:!?\x0A-\x0D]') AS ps FROM d)),
w AS (SELECT lang, k, piece, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (SELECT *, regexp_extract_all(x, '[^\x20\x09]+') AS ws FROM p)),
g AS (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY k, piece ORDER BY i)),
f1 AS (SELECT lang, w1 AS phrase, count(*) AS c FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1 || ' ' || w2 AS phrase, w1, w2, count(*) AS c FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING c >= 10),
f3 AS (SELECT lang, w1 || ' ' || w2 || ' ' || w3 AS phrase, w1, w2, w3, count(*) AS c FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING c >= 10),
f AS (SELECT * FROM f1 UNION ALL SELECT lang, phrase, c FROM f2),
cut AS (SELECT lang, phrase, c AS a, 1 AS k, w1 AS x, w2 AS y FROM f2
  UNION ALL SELECT lang, phrase, c, 1, w1, w2 || ' ' || w3 FROM f3 UNION ALL SELECT lang, phrase, c, 2, w1 || ' ' || w2, w3 FROM f3),
s AS (SELECT cut.lang, cut.phrase, a, k, l.c AS l, r.c AS r, (1000000::HUGEINT * a * a) // (l.c::HUGEINT * r.c) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM s),
h AS (SELECT lang, phrase, max(c) AS longer FROM (SELECT lang, w1 || ' ' || w2 AS phrase, c FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, c FROM f3) GROUP BY ALL),
z AS (SELECT b.*, n FROM b JOIN (SELECT lang, sum(c) AS n FROM f1 GROUP BY lang) USING (lang) LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE nth = 1 AND (longer IS NULL OR 100 * longer < 50 * a)),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM q WHERE rank <= 2000
"""

SQL: dict[str, str] = {"op11_kd_search": _OP11, "op12_filter_audit": _OP12, "op13_collocations": _OP13, "op3_quality": _OP3, "op5_chat": _OP5}
