"""Counts per pair of bins: one scan of the book from which bins, IV and correlations follow.

Each row adds one to a cell (bin of a, bin of b) for every pair of features, the target being
one of them.  Each task adds its rows up in arrays and hands over its cells, of which there
are only features x features x bins x bins, whatever the number of rows.  A value per bin, such as its WoE, then
gives every correlation exactly, and folding bins needs no second scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradus.functions.columns import MISSING_BIN, bin_index, number
from gradus.operators.woe import WoeBins

CELL_SCHEMA = "a string, bin_a int, b string, bin_b int, n long"


def joint_bin_counts(df: DataFrame, edges: dict[str, list[float]], target: str) -> DataFrame:
    """Rows per (a, bin_a, b, bin_b) for every pair of features in order, and of each with the target.

    Bins are those of ``edges``, right-closed, with Missing; the target's bins are its values 0
    and 1, and a row whose target is neither is Missing there.
    """
    names = [*edges, target]
    width = max((len(e) for e in edges.values()), default=0) + 3  # Missing is one of them
    y = F.col(target).cast("bigint")
    label = F.when(y.isin(0, 1), y.cast("int")).otherwise(MISSING_BIN)
    clean = df.select(label.alias("_y"), *[number(f).alias(f) for f in edges])
    placed = clean.select(*[(bin_index(f, e) - MISSING_BIN).cast("int").alias(f"b{i}") for i, (f, e) in enumerate(edges.items())], (F.col("_y") - MISSING_BIN).cast("int").alias(f"b{len(edges)}"))
    pairs = list(combinations(range(len(names)), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], CELL_SCHEMA)

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((len(pairs), width * width), dtype=np.int64)
        for batch in batches:
            bins = [column.to_numpy().astype(np.intp) for column in batch.columns]
            for p, (i, j) in enumerate(pairs):
                cells[p] += np.bincount(bins[i] * width + bins[j], minlength=width * width)
        counts = cells.ravel()
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(counts[met], pa.int64())], names=["code", "n"])

    counted = placed.mapInArrow(tallied, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    pair, cell = F.expr(f"cast(code div {width * width} as int)"), F.col("code") % (width * width)
    name = lambda side: F.get(F.array(*[F.lit(names[p[side]]) for p in pairs]), pair)
    return counted.select(
        name(0).alias("a"), (F.floor(cell / width).cast("int") + MISSING_BIN).alias("bin_a"),
        name(1).alias("b"), ((cell % width).cast("int") + MISSING_BIN).alias("bin_b"), "n",
    )


def counts_by_bin(joint: DataFrame, target: str) -> DataFrame:
    """feature, bin_index, count, goods and bads, from the cells with the target."""
    sides = joint.where(F.col("b") == target)
    return sides.groupBy(F.col("a").alias("feature"), F.col("bin_a").alias("bin_index")).agg(
        F.sum("n").alias("count"), F.sum(F.when(F.col("bin_b") == 0, F.col("n")).otherwise(0)).alias("goods"), F.sum(F.when(F.col("bin_b") == 1, F.col("n")).otherwise(0)).alias("bads")
    )


def bin_values(bins: WoeBins, edges: dict[str, list[float]]) -> list[tuple[str, int, float]]:
    """WoE of each bin of ``edges``, of which the fitted bins may be unions."""
    rows = []
    for f, fitted in bins.features.items():
        cuts = fitted.edges
        rows += [(f, i, fitted.woe[sum(c < e for c in cuts)]) for i, e in enumerate(edges[f])]
        rows += [(f, len(edges[f]), fitted.woe[len(cuts)]), (f, MISSING_BIN, fitted.missing_woe)]
    return rows


def correlations(joint: DataFrame, values: list[tuple[str, int, float]], features: list[str]) -> DataFrame:
    """Pearson correlation (a, b, corr) of every pair of features whose bins have ``values``.

    Exact, from the cells alone: sums around the mean over at most features x features x bins x
    bins rows.  A feature of one value, or without rows, has no correlation (NULL).
    """
    spark = joint.sparkSession
    wanted = F.broadcast(spark.createDataFrame(list(combinations(features, 2)), "a string, b string"))
    table = spark.createDataFrame(values, "feature string, bin_index int, value double")
    x, y = (F.broadcast(table.toDF(f"f_{s}", f"i_{s}", f"v_{s}")) for s in "ab")
    order = {f: i for i, f in enumerate(features)}
    # Cells are in the order of the scan; the wanted pair may be the other way round.
    turned = joint.where(F.col("a").isin(features) & F.col("b").isin(features))
    rank = lambda c: F.coalesce(*[F.when(F.col(c) == f, i) for f, i in order.items()])
    ahead = rank("a") < rank("b") if features else F.lit(True)
    turned = turned.select(*[F.when(ahead, F.col(p)).otherwise(F.col(q)).alias(p) for p, q in (("a", "b"), ("bin_a", "bin_b"), ("b", "a"), ("bin_b", "bin_a"))], "n")
    met = turned.join(x, (F.col("a") == F.col("f_a")) & (F.col("bin_a") == F.col("i_a"))).join(y, (F.col("b") == F.col("f_b")) & (F.col("bin_b") == F.col("i_b")))
    pair = Window.partitionBy("a", "b")
    mean = lambda v: F.sum(F.col("n") * F.col(v)).over(pair) / F.sum("n").over(pair)
    centred = met.select("a", "b", "n", "v_a", "v_b", (F.col("v_a") - mean("v_a")).alias("d_a"), (F.col("v_b") - mean("v_b")).alias("d_b"))
    product = lambda p, q: F.sum(F.col("n") * F.col(p) * F.col(q))
    varies = (F.min("v_a") < F.max("v_a")) & (F.min("v_b") < F.max("v_b"))
    found = centred.groupBy("a", "b").agg(F.when(varies, product("d_a", "d_b") / F.sqrt(product("d_a", "d_a") * product("d_b", "d_b"))).alias("corr"))
    return wanted.join(found, ["a", "b"], "left").select("a", "b", "corr")
