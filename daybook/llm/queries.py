"""The registered queries of the operators in this subpackage, and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table
and returns the whole result.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import chat, decontaminate, hard_negatives, html_text, language_id, mixing, ngram_join, periodic, pii, quality, secrets, token_counts, toxicity
from daybook.llm.tables import table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents")).drop("digest")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed", "kept")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(table(spark, sf_dir, "documents"))
    return token_counts.suffix_sums(token_counts.length_histogram(lengths)).drop("key")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).drop("redacted")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label)
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places from which ``op13`` reads the words of a document: those of the periodic documents repeat."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), order=planted_order)
    best = periodic.longest_run(F.col("runs"))
    out = found.select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        periodic.runs_digest(F.col("runs")).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli")
    return out.select("doc_id", "n_words", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_quality_rules, op3_token_counts, op4_toxicity, op5_mixing,
        op6_chat_format, op7_html_text, op8_pii_surrogates, op9_secrets, op10_decontamination, op11_language_id, op12_hard_negatives, op13_periodic_runs,
    )
}

ORACLE_SQL = {}

ORACLE_SQL["op1_ngram_jaccard"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), 'abcdefghijklmnopqrstuvwxyz     '), ' '), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY 1) r ON r.a = d.doc_id
"""

_PLAIN = "translate(coalesce(text, ''), chr(9) || chr(11) || chr(12) || chr(13), '    ')"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000'"

ORACLE_SQL["op2_quality_rules"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t,
    string_split(coalesce(text, ''), chr(10)) AS raw, string_split({_PLAIN}, chr(10)) AS plain FROM documents),
l AS MATERIALIZED (SELECT r, host, raw, list_filter(string_split(plain, ' '), lambda x: x <> '') AS w
  FROM (SELECT r, host, unnest(raw) AS raw, unnest(plain) AS plain FROM d)),
n AS MATERIALIZED (SELECT r, host, raw, len(w) AS n_words, translate(array_to_string(w, ' '), {_FOLD}) AS line FROM l WHERE len(w) > 0),
w AS MATERIALIZED (SELECT r, host, doc_id, t, list_filter(string_split(translate({_PLAIN.replace("coalesce(text, '')", 't')}, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM d),
k AS MATERIALIZED (SELECT r, host, md5(translate(array_to_string(w, ' '), {_FOLD})) AS kind FROM w),
common AS MATERIALIZED (SELECT host, line FROM n JOIN k USING (r, host) GROUP BY host, line
  HAVING count(DISTINCT kind) > 10 AND count(DISTINCT kind) > 0.05 * (SELECT count(DISTINCT kind) FROM k h WHERE h.host = n.host)),
removed AS (SELECT r, sum(n_words)::BIGINT AS n_removed FROM n JOIN common USING (host, line) GROUP BY r),
dup AS (SELECT r, (count(*) - count(DISTINCT raw))::BIGINT AS n_dup_lines FROM n GROUP BY r),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2))),
rep AS (SELECT r, count(DISTINCT i)::BIGINT AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM g WHERE k > 1) GROUP BY r),
o AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_removed, 0) AS n_removed FROM w LEFT JOIN removed USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_removed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT n_removed > 0.5 * n_words AS kept FROM o
"""

ORACLE_SQL["op12_hard_negatives"] = """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

#: crc32 of the text of an integer, from the ASCII codes of its digits (polynomial 0xEDB88320, one bit at a time).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
  lambda c, x: list_reduce(list_prepend(xor(c, x), list_transform(range(8), lambda z: 0::UBIGINT)), lambda d, z: xor(d >> 1, (d & 1) * 3988292384::UBIGINT))))"""

# Two equal five-word passages p apart start in every word of a run but its last p + 4, without a gap.
ORACLE_SQL["op13_periodic_runs"] = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS w,
    {_CRC} AS h FROM documents),
p AS (SELECT doc_id, w, len(w) AS n, h, CASE WHEN len(w) > 0 THEN ((h // 10) % len(w))::BIGINT END AS a FROM d),
q AS (SELECT *, (1 + (n - a) // (3 + (h // 10) % 8))::BIGINT AS p FROM p),
t AS MATERIALIZED (SELECT doc_id, n, CASE WHEN n > 0 AND h % 10 = 0
  THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM q),
g AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS g FROM (SELECT doc_id, w, unnest(range(n - 4)) AS i FROM t WHERE n >= 6)),
o AS (SELECT x.doc_id, x.i, y.i - x.i AS p FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i),
e AS (SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM o),
s AS (SELECT doc_id, p, min(i) AS start, count(*) + 4 + p AS length FROM e GROUP BY doc_id, p, island HAVING count(*) + 4 + p >= greatest(6, 4 * p)),
r AS MATERIALIZED (SELECT doc_id, start, length, min(p) AS period FROM s GROUP BY 1, 2, 3),
f AS (SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := start, l := length, p := period), (-length, start, period)) AS b,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS collapsed FROM (SELECT doc_id, unnest(w) AS x, unnest(range(n)) AS i FROM t)
  ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT doc_id, n AS n_words, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.l::BIGINT AS length, b.p::BIGINT AS period,
  (1000 * b.l // b.p)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM t LEFT JOIN f USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
