"""Queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.llm import hard_negatives


def op11_tree_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {"op11_tree_bounds": op11_tree_bounds}

_OP11 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::bigint + 1) % 10 ELSE label::bigint END AS label, list_transform(embedding, lambda x: floor(256 * x::double)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = x.label AS same, x.vec_id, list_sum(list_transform(list_zip(a.v, x.v), lambda p: p[1] * p[2]))::bigint AS score
  FROM usable a JOIN usable x ON a.vec_id <> x.vec_id AND len(a.v) = len(x.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
windows AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id, score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::int AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM windows WHERE rank <= 5
"""
ORACLES: dict[str, str] = {"op11_tree_bounds": _OP11}
