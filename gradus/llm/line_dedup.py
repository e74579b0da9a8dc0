"""Removal of lines that repeat earlier ones, three in a row at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.columns import SPACE, let
from gradus.sources.tables import materialise

LINES = 3
#: Removed line numbers that may be sent to every executor.
BROADCAST_LINES = 500_000


def _windows(lines: Column, width: int) -> Column:
    """Place and two hashes of each run of ``width`` lines with a word in one of them."""
    places = F.sequence(F.lit(0), F.size(lines) - width)

    def one(i: Column) -> Column:
        own = [F.element_at(lines, i + j + 1) for j in range(width)]
        worded = F.length(F.regexp_replace(F.concat(*own), SPACE + "+", "")) > 0
        return F.struct(i.alias("place"), F.when(worded, F.xxhash64(*own)).alias("h"), F.xxhash64(*own[::-1]).alias("g"))

    made = F.transform(places, one)
    return F.when(F.size(lines) >= width, F.filter(made, lambda w: w["h"].isNotNull()))


def _kept(lines: Column, gone: Column) -> Column:
    """Lines whose number is not among ``gone``, joined again."""
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(left, lambda i: F.element_at(lines, i + 1)), "\n")


def remove_repeated_lines(docs: DataFrame, width: int = LINES) -> DataFrame:
    """doc_id, n_lines, n_removed and the kept text of every row of ``docs``.

    Lines are what ``\\n`` separates, compared as they are.  Every run of ``width`` lines that
    occurred before, in the order of doc_id (null last) and place, covers its lines; covered
    lines go, whether one run covers them or several.  The first occurrence stays.  Runs without
    a word, and texts of fewer lines, cover nothing.  A null text counts as empty, which is
    one empty line.  Rows that repeat a doc_id and its text are one document, and stay or lose
    lines together.
    """
    read = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("k", F.xxhash64("doc_id", "text"))
    lines = F.split("text", "\n", -1)
    rows = materialise(read.select("k", "doc_id", F.explode(let(lines, lambda l: _windows(l, width))).alias("w")).select("k", "doc_id", "w.*"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("place"))
    # Within a document first, so that a run that is common in it is one row in the shuffle.
    own = rows.groupBy("h", "g", "k").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = own.groupBy("h", "g").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1").select("h", "g", "first")
    later = rows.join(firsts, ["h", "g"]).where(order > F.col("first")).select("k", "place")
    covered = F.array_distinct(F.flatten(F.transform(F.collect_list("place"), lambda p: F.sequence(p, p + (width - 1)))))
    gone = materialise(later.groupBy("k").agg(covered.alias("gone")))
    size = gone.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0)).alias("n")).first()["n"]
    met = read.join(F.broadcast(gone) if size <= BROADCAST_LINES else gone, "k", "left")
    # The text is split once, not once for each line that looks into it.
    kept = let(lines, lambda l: _kept(l, F.col("gone")))
    return met.select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
    )
