"""Exact duplicates: heavy digests are decided by broadcast, the others by one shuffle.

A mergeable frequent-items summary (Misra-Gries counters, merged in two levels) names every
digest that could hold at least ``1 / HEAVY`` of the rows.  Those are counted exactly, and
the ones that do are the heavy digests: at most ``HEAVY`` of them, so their winners can be
sent to all tasks, which decide their rows without a shuffle.  The winners of digests that are
left are aggregated before they are shuffled, and joined back; no group is held as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.columns import SPACE, fresh, packed, text_of, without
from gradus.sources.tables import materialise

#: A digest with more than a HEAVY-th of the rows is heavy.
HEAVY = 4_096
#: Counters of the summary.  Its error is at most 3.5 / COUNTERS of the rows, below 1 / HEAVY.
COUNTERS = 16_384
MERGE_WIDTH = 256


def digest_of(text: Column) -> Column:
    """SHA-256 of the text without its white space."""
    return F.sha2(F.regexp_replace(text, SPACE + "+", ""), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest, size in code points, and a number of the row; written, read once from text."""
    rows = docs.select(F.col("doc_id"), digest_of(text_of()).alias("digest"), F.char_length(text_of()).cast("long").alias("size"))
    return materialise(rows.withColumn("rid", F.monotonically_increasing_id()))


def heavy_candidates(rows: DataFrame) -> DataFrame:
    """Digests (at most HEAVY) that may have a HEAVY-th of the rows; one that is missed is decided like a light one."""
    state = F.expr(f"approx_top_k_accumulate(digest, {COUNTERS})").alias("state")
    merged = F.expr(f"approx_top_k_combine(state, {COUNTERS})").alias("state")
    parts = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_WIDTH)).alias("part")).agg(state)
    whole = parts.groupBy(F.lit(0).alias("part")).agg(merged)
    top = whole.select(F.explode(F.expr(f"approx_top_k_estimate(state, {HEAVY})")).alias("top"))
    return top.select(F.col("top.item").alias("digest"))


def _winners(rows: DataFrame) -> DataFrame:
    """digest, group_size, keep_id and keep_rid of every digest."""
    first = F.min(F.struct(-F.col("size"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))).alias("first")
    counted = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), first)
    return counted.select("digest", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.rid").alias("keep_rid"))


def heavy_winners(rows: DataFrame) -> DataFrame:
    """digest, keep_id, keep_rid, group_size of the digests that are heavy by exact count."""
    total = rows.count()
    counted = _winners(rows.join(F.broadcast(heavy_candidates(rows)), "digest"))
    return counted.where((F.col("group_size") >= 2) & (F.col("group_size") * F.lit(HEAVY) > F.lit(total)))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 and size.

    Texts are equal when identical without their white space; null counts as empty, and empty
    texts are equal.  The row with the most code points stays, then the smallest doc_id (null
    last), then any one of rows that agree in both, so of repeated rows just one is kept.
    An empty table gives no rows.
    """
    rows = digests(docs)
    winners = F.broadcast(materialise(heavy_winners(rows)))
    rest = rows.join(winners, "digest", "left_anti")
    decided = rows.join(winners, "digest").unionByName(rest.join(_winners(rest), "digest"))
    return decided.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), F.col("digest").alias("text_sha256"), "size")


def deduplicate(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, with one row of each group of equal texts.

    Rows go by doc_id.  Only rows whose doc_id is null or repeated are looked at by text
    again, to keep a single one of rows that the id cannot tell apart.
    """
    decided = materialise(exact_groups(docs).select("doc_id", "kept", F.col("text_sha256").alias("digest"), "size"))
    lost = decided.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id")
    odd = materialise(
        decided.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull()).select("doc_id")
    )
    if odd.isEmpty():
        return without(docs, lost)
    plain = without(without(docs.where(F.col("doc_id").isNotNull()), odd), lost)
    mark = fresh(docs, "_odd_id")
    marks = odd.withColumnRenamed("doc_id", mark)
    kept = decided.where("kept").join(marks, F.col("doc_id").eqNullSafe(F.col(mark)), "left_semi")
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest"), F.col("size").alias("_kept_size"))
    strange = docs.join(marks, docs["doc_id"].eqNullSafe(F.col(mark)), "left_semi")
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    strange = packed(strange).select("row", digest_of(text).alias("_digest"), F.char_length(text).cast("long").alias("_size"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest")) & (F.col("_size") == F.col("_kept_size"))
    one = strange.join(kept, same, "left_semi").groupBy(F.col("row.doc_id").alias("_id"), "_digest", "_size").agg(F.first("row").alias("row"))
    return plain.unionByName(one.select("row.*"))
