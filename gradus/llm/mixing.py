"""Mixing sources to target weights by systematic sampling.

Each document expects ``target / size`` of its source in copies.  The expectations are
summed in one order over the source, one random offset is added, and a document is emitted
once for each integer that its stretch of the sum crosses.  Expectations are whole
multiples of ``1 / UNIT``, so sums are exact and every run agrees.

The order is by size, then by a hash of the id: neighbours are alike, so every stretch of
sizes gets its share of words.  The running sum is taken in three levels, of sizes in the
source, of hash cells in a size, of rows in a cell, so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.llm.columns import packed, words

#: Fixed values of the mix: weights by the source's place, share of all sizes, most copies.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST = 2
SEED = 42
#: Expected copies are counted in this part of a copy.
UNIT = 1 << 20
#: Hex digits of the cell inside one size of one source.
CELL = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST) -> DataFrame:
    """source, source_size, target of a table (source, size).

    Sources by code point, null last, weigh ``weights`` in turn.  ``share_percent`` of all sizes
    is shared by weight; no target exceeds ``most`` times its source, what is over is shared
    again.  Sources that fill up are those of the least room per weight.  In that order the
    level of the rest is the one at the first source that doesn't fill; past it levels only
    sink, so it is the highest of those that fit.  One row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()))
    table = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = totals.select("*", F.element_at(table, F.pmod(place - 1, F.lit(len(weights))) + 1).alias("weight"))
    room = F.col("source_size") * F.lit(most)
    by_room = Window.partitionBy(F.lit(0)).orderBy(room / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    laid = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("all_sizes"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
        F.coalesce(F.sum(room).over(before), F.lit(0)).alias("filled"),
        room.alias("room"),
    )
    # Level if all sources before this one are full; in hundredths, so that it is a quotient of integers.
    level = (F.col("all_sizes") * F.lit(share_percent) - F.col("filled") * F.lit(100)).cast("double") / (F.lit(100.0) * F.col("weight_left"))
    levelled = laid.select("*", level.alias("level")).select(
        "*", F.max(F.when(F.col("level") * F.col("weight") <= F.col("room"), F.col("level"))).over(everything).alias("final_level")
    )
    full = F.col("room").cast("double")
    target = F.when(F.col("final_level").isNull(), full).otherwise(F.least(full, F.col("final_level") * F.col("weight")))
    return levelled.select("source", "source_size", target.alias("target"))


def _offset(source: Column, seed: int) -> Column:
    """The source's random offset, in units below one copy."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), source)), 1, 5), 16, 10).cast("long")


def copies(
    docs: DataFrame, carry: list[str] | None = None, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST
) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), size, source_size, target and copies, for every row.

    Size is the number of words; a null text has none.  Null is a source of its own.  A
    document without words expects copies like any other of its source, they add nothing;
    a source without words is left out.  Rows that repeat a doc_id are documents of their
    own.  An empty table gives no rows.
    """
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    # The source as a key that is never null, so that join and window agree on where rows go.
    source = F.coalesce(F.concat(F.lit("+"), F.col("row.source").cast("string")), F.lit("-"))
    kept = [F.col("row")[c].alias(c) for c in (docs.columns if carry is None else carry)]
    sized = packed(docs).select(
        F.struct(*kept).alias("row"), F.col("row.doc_id").alias("id"), source.alias("source"), F.size(words(text)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))).alias("key"),
    ).withColumn("cell", F.substring("key", 1, CELL))
    # The counts read source, size and cell alone: at most one row per cell reaches a task.
    cells = sized.groupBy("source", "size", "cell").agg(F.count(F.lit(1)).alias("n"))
    by_size = cells.groupBy("source", "size").agg(F.sum("n").alias("size_n"))
    sources = by_size.select(F.when(F.col("source") != "-", F.substr("source", F.lit(2))).alias("source"), (F.col("size") * F.col("size_n")).alias("size"))
    targets = source_targets(sources, weights, share_percent, most)
    lower = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = by_size.select("source", "size", F.coalesce(F.sum("size_n").over(lower), F.lit(0)).alias("below"))
    earlier = Window.partitionBy("source", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.select("source", "size", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("inside"))
    named = targets.select(F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-")).alias("source"), "source_size", "target")
    expected = F.round(F.lit(float(UNIT)) * F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))).cast("long")
    starts = placed.join(sizes, ["source", "size"]).join(named, "source").select(
        "source", "size", "cell", (F.col("below") + F.col("inside")).alias("before"), "source_size", "target", expected.alias("expected")
    )
    found = sized.join(starts, ["source", "size", "cell"])
    in_cell = Window.partitionBy("source", "size", "cell").orderBy("key", "id")
    rank = F.col("before") + F.row_number().over(in_cell)
    return found.select("row", "source", "size", "source_size", "target", "expected", rank.alias("rank")).select(
        "row", "size", "source_size", "target", _crossed(_offset(F.col("source"), seed)).alias("copies")
    )


def _crossed(offset: Column) -> Column:
    """Integers that the document's stretch of the running sum crosses."""
    upto = offset + F.col("rank") * F.col("expected")
    return (F.floor(upto / F.lit(UNIT)) - F.floor((upto - F.col("expected")) / F.lit(UNIT))).cast("long")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, columns unchanged."""
    drawn = copies(docs, **options)
    return drawn.where(F.col("copies") > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
