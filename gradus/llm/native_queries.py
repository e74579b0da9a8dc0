"""Queries of the operators that are DataFrame functions throughout, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradus.llm import exact_dedup, mixing, quality_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    drawn = mixing.copies(docs, carry=["doc_id"])
    return drawn.selectExpr("row.doc_id as doc_id", "size", "source_size", "target", "copies * size as taken", "copies")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality_rules.judge(docs, _table(spark, sf_dir, "labels"), carry=["doc_id"]).drop("row")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(docs).drop("size")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP3 = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::bigint AS size, md5(coalesce(doc_id::varchar, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::bigint AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::bigint AS weight FROM s),
laid AS (
  SELECT *, 2 * source_size AS room, sum(source_size) OVER () AS all_sizes,
    sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weight_left, coalesce(sum(2 * source_size) OVER o, 0) AS filled
  FROM w WINDOW o AS (ORDER BY (2 * source_size)::double / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT *, (all_sizes * 150 - filled * 100)::double / (100.0::double * weight_left::double) AS level FROM laid),
fin AS (SELECT *, max(CASE WHEN level * weight <= room THEN level END) OVER () AS final_level FROM lev),
t AS (
  SELECT source, source_size, CASE WHEN final_level IS NULL THEN room::double ELSE least(room::double, final_level * weight) END AS target,
    CAST('0x' || substr(md5('42|' || CASE WHEN source IS NULL THEN '-' ELSE '+' || source END), 1, 5) AS bigint) AS u
  FROM fin),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
    round(1048576.0::double * CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END)::bigint AS e,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.k, d.doc_id) AS n
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, ((u + n * e) // 1048576 - (u + (n - 1) * e) // 1048576)::bigint AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""

_RULES = quality_rules.RULES
_LONG = " UNION ALL ".join(
    f"SELECT doc_id, stratum, good, '{rule}' AS rule, CASE WHEN {under} > 0 THEN {over} * 1000 // {under} ELSE 0 END AS v FROM fit"
    for rule, (over, under) in _RULES.items()
)
_PART = quality_rules.RISK / len(_RULES)
_PASS = " AND ".join(
    f"(cut_{rule} IS NULL OR CASE WHEN {under} > 0 THEN {over} * 1000 // {under} ELSE 0 END <= cut_{rule})" for rule, (over, under) in _RULES.items()
)
_OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, lang AS stratum, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
p AS (SELECT id, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM d),
g AS (SELECT id, pos, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS g
  FROM p WINDOW o AS (PARTITION BY id ORDER BY pos)),
h AS (SELECT id, pos FROM (SELECT id, pos, count(*) OVER (PARTITION BY id, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1),
rep AS (SELECT id, count(DISTINCT pos + j)::bigint AS n_repeat_words FROM h, (SELECT unnest(range(5)) AS j) GROUP BY id),
ln AS (SELECT id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT d.id, d.doc_id, d.stratum, len(w)::bigint AS n_words, length(array_to_string(w, ''))::bigint AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols, length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint AS n_capitals,
    len(l)::bigint AS n_lines, (len(l) - len(list_distinct(l)))::bigint AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN ln USING (id) LEFT JOIN rep USING (id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
fit AS (SELECT b.*, good FROM b JOIN (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id) USING (doc_id) WHERE NOT base_failed),
long AS ({_LONG}),
cells AS (SELECT stratum, rule, v, sum(good)::bigint AS good, sum(1 - good)::bigint AS bad FROM long GROUP BY ALL),
tried AS (
  SELECT stratum, rule, v, sum(good) OVER a AS n_good, sum(bad) OVER a AS n_bad, coalesce(sum(good) OVER u, 0) AS good_lost, coalesce(sum(bad) OVER u, 0) AS bad_lost
  FROM cells WINDOW a AS (PARTITION BY stratum, rule), u AS (PARTITION BY stratum, rule ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
sizes AS (SELECT stratum, max(n_good) AS n FROM tried GROUP BY stratum),
steps AS (SELECT stratum, n, unnest(range(0, ceil(n * {_PART!r})::bigint + 1)) AS i FROM sizes),
mass AS (
  SELECT stratum, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_PART!r}) + (n - i) * ln(1 - {_PART!r})))
    OVER (PARTITION BY stratum ORDER BY i) AS mass FROM steps WHERE i <= n),
quota AS (SELECT stratum, coalesce(max(i) FILTER (mass <= {quality_rules.DELTA!r} / ((SELECT count(*) FROM sizes) * {len(_RULES)})), -1) AS quota FROM mass GROUP BY stratum),
best AS (
  SELECT t.stratum, rule, arg_max(v, (bad_lost * n_good - good_lost * n_bad) * 10000 + v) AS cut FROM tried t JOIN quota q ON t.stratum IS NOT DISTINCT FROM q.stratum
  WHERE good_lost <= quota AND bad_lost * n_good > good_lost * n_bad GROUP BY ALL),
cuts AS (SELECT stratum, {", ".join(f"max(cut) FILTER (rule = '{r}') AS cut_{r}" for r in _RULES)} FROM best GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_PASS} AS kept
FROM b LEFT JOIN cuts ON b.stratum IS NOT DISTINCT FROM cuts.stratum
"""

_OP10 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS size, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST)
"""

QUERIES = {"op3_mixing": op3_mixing, "op4_quality_rules": op4_quality_rules, "op10_exact_dedup": op10_exact_dedup}
ORACLES = {"op3_mixing": _OP3, "op4_quality_rules": _OP4, "op10_exact_dedup": _OP10}
