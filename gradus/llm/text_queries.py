"""Queries of the operators that run numpy or Python inside tasks, with SQL where it can express them."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.llm import bpe, collocations, fingerprints, katz, line_dedup, minhash, nbsvm, repeats, token_files

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *columns, "text")


def rank_file() -> bytes:
    return Path(public_tokenizers.path(TOKENIZER)).read_bytes()


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_documents(_documents(spark, sf_dir), scanned=True)
    counted = token_files.named(token_files.scan(token_files.blocks_of_files(spark, files.path)), files)
    return counted.select("doc_id", "n_tokens")


def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.remove_repeated_lines(_documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return nbsvm.scores(_documents(spark, sf_dir), labels, F.crc32(F.col("doc_id").cast("string")) % 3 == 1)


def op2_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(_documents(spark, sf_dir))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(_documents(spark, sf_dir), width=4, percent=80)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(_documents(spark, sf_dir), rank_file(), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scores(_documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op12_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_next(_documents(spark, sf_dir))


def op13_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


QUERIES = {
    "op1_separator_scan": op1_separator_scan, "op2_debruijn": op2_debruijn, "op5_line_windows": op5_line_windows, "op6_minhash": op6_minhash,
    "op7_nbsvm": op7_nbsvm, "op8_byte_bpe": op8_byte_bpe, "op9_katz": op9_katz, "op12_bottom_k": op12_bottom_k, "op13_tiles": op13_tiles,
}
_OP2 = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT id, generate_subscripts(w, 1) AS pos, unnest(w) AS x FROM d),
g AS (SELECT p.id, pos, sha256(array_to_string(w[pos : pos + 34], ' ')) AS g FROM p JOIN d USING (id) WHERE pos + 34 <= len(w)),
h AS (SELECT id, pos FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1),
c AS (SELECT p.id, pos, x, max(h.pos) OVER (PARTITION BY p.id ORDER BY p.pos) AS last FROM p LEFT JOIN h USING (id, pos)),
k AS (SELECT id, count(*) AS n_kept, string_agg(x, ' ' ORDER BY pos) AS kept FROM c WHERE last IS NULL OR pos > last + 34 GROUP BY id)
SELECT doc_id, len(w)::bigint AS n_words, (len(w) - coalesce(n_kept, 0))::bigint AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (id)
"""
_OP1 = r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS n_tokens FROM documents"

_OP5 = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
p AS (SELECT id, doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS x FROM d),
w AS (SELECT id, doc_id, pos, x || chr(10) || lead(x, 1) OVER o || chr(10) || lead(x, 2) OVER o AS g FROM p WINDOW o AS (PARTITION BY id ORDER BY pos)),
r AS (SELECT id, pos, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, pos) AS n FROM w WHERE regexp_matches(g, '[^\x20\x09-\x0D]')),
c AS (SELECT p.id, p.pos, x, max(r.pos) OVER (PARTITION BY p.id ORDER BY p.pos) AS last FROM p LEFT JOIN (FROM r WHERE n > 1) r USING (id, pos)),
k AS (SELECT id, count(*) AS n_kept, string_agg(x, chr(10) ORDER BY pos) AS kept FROM c WHERE last IS NULL OR pos > last + 2 GROUP BY id)
SELECT doc_id, len(l)::bigint AS n_lines, (len(l) - coalesce(n_kept, 0))::bigint AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (id)
"""
_OP13 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT id, lang, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM w),
o AS (SELECT lang, x, lead(x) OVER q AS y, lead(x, 2) OVER q AS z FROM t WINDOW q AS (PARTITION BY id ORDER BY pos)),
g AS (
  SELECT lang, 1 AS m, x AS phrase FROM o UNION ALL SELECT lang, 2, x || ' ' || y FROM o WHERE y IS NOT NULL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM o WHERE z IS NOT NULL),
f AS (SELECT lang, m, phrase, lang || chr(9) || phrase AS name, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::bigint AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS x FROM f WHERE m > 1 AND f >= 10),
i AS (SELECT *, unnest(range(1, m)) AS k FROM c),
k AS (SELECT *, lang || chr(9) || array_to_string(x[1 : k], ' ') AS head, lang || chr(9) || array_to_string(x[k + 1 :], ' ') AS tail FROM i),
s AS (
  SELECT k.lang, k.m, k.phrase, a, k, l.f AS l, r.f AS r, (1000000::hugeint * a * a) // (l.f::hugeint * r.f) AS score
  FROM k JOIN f l ON l.name = head JOIN f r ON r.name = tail),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (
  SELECT lang, part, max(a) AS held FROM (SELECT lang, a, unnest([x[1] || ' ' || x[2], x[2] || ' ' || x[3]]) AS part FROM c WHERE m = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::bigint AS score
FROM b JOIN n USING (lang) LEFT JOIN h ON b.lang = h.lang AND b.phrase = h.part WHERE held IS NULL OR 100 * held < 50 * a
QUALIFY rank <= 2000
"""
ORACLES: dict[str, str] = {"op13_tiles": _OP13, "op1_separator_scan": _OP1, "op2_debruijn": _OP2, "op5_line_windows": _OP5}
