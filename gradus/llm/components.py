"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.sources.tables import materialise


def _nearest(edges: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its neighbours; combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = both.join(_nearest(both), F.col("u") == F.col("n")).where(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    own = least.select("u", F.col("m").alias("v"))
    others = edges.join(least.withColumnRenamed("u", "n"), F.col("u") == F.col("n")).where(F.col("v") != F.col("m"))
    return own.unionByName(others.select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id in ``links`` (a, b).

    Links of an id with itself and repeated links add nothing; null ends are left out.  Each
    round is a written table, so a lost executor costs tasks, not rounds.  No group of
    neighbours is gathered: a step is a minimum per node and a join, so a hub is as good as any.
    """
    edges = materialise(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _mark(edges)
    while True:
        edges = materialise(_small_star(_large_star(edges)))
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
