"""Isotonic regression by pooled blocks that can be merged.

Counted scores are split by ranges.  Each range is pooled on its own into blocks of rising bad
rate; blocks of neighbouring ranges are pooled again, a few ranges at a time, until one range
is left.  Pooling blocks of pooled blocks gives what pooling all rows would.  Rates are
compared as fractions of whole numbers, so the result does not depend on the ranges.

Rising fractions with ``n`` rows in all are fewer than about ``n ** (2/3)``, which is what the
last task holds, however many scores there are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.operators.ordering import CUT_SKETCH, ROWS_PER_BUCKET, sketched_quantiles
from gradus.sources.tables import materialise

#: Ranges that are pooled together at a time.
FAN_IN = 16
_BLOCKS = "place long, lo double, hi double, n long, bads long"


def _pool(blocks: DataFrame) -> DataFrame:
    """Blocks of each ``place`` pooled until their bad rates rise strictly."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("lo")
        kept: list[list] = []
        for lo, hi, n, bads in zip(*(table.column(c).to_pylist() for c in ("lo", "hi", "n", "bads"))):
            while kept and kept[-1][3] * n >= bads * kept[-1][2]:
                before = kept.pop()
                lo, n, bads = before[0], n + before[2], bads + before[3]
            kept.append([lo, hi, n, bads])
        place = table.column("place")[0].as_py()
        cells = [np.array(c) for c in zip(*kept)]
        return pa.table({"place": pa.array([place] * len(kept), pa.int64()), "lo": pa.array(cells[0], pa.float64()), "hi": pa.array(cells[1], pa.float64()), "n": pa.array([b[2] for b in kept], pa.int64()), "bads": pa.array([b[3] for b in kept], pa.int64())})

    return blocks.groupBy("place").applyInArrow(run, _BLOCKS)


def pooled_blocks(counted: DataFrame, rows_per_range: int = ROWS_PER_BUCKET, fan_in: int = FAN_IN) -> DataFrame:
    """lo, hi, n and bads of each block, from one row per score (``p``, ``n``, ``bads``).

    Scores that are null or NaN take no part.
    """
    scores = materialise(counted.where(F.col("p").isNotNull() & ~F.isnan("p")).select(F.col("p").alias("lo"), F.col("p").alias("hi"), F.col("n").cast("long").alias("n"), F.col("bads").cast("long").alias("bads")))
    ranges = max(1, math.ceil(scores.count() / rows_per_range))
    cuts: list[float] = []
    if ranges > 1:
        found = sketched_quantiles(scores, ["lo"], [i / ranges for i in range(1, ranges)], CUT_SKETCH).first()["q_0"]
        cuts = sorted({c for c in found or [] if math.isfinite(c)})
    placed = scores.withColumn("place", F.lit(0).cast("long"))
    if cuts:
        placed = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="lo", outputCol="_at").transform(scores).withColumn("place", F.col("_at").cast("long")).drop("_at")
    left = len(cuts) + 1
    blocks = _pool(placed.select("place", "lo", "hi", "n", "bads"))
    while left > 1:
        blocks = _pool(materialise(blocks).withColumn("place", F.expr(f"place div {fan_in}")))
        left = math.ceil(left / fan_in)
    return blocks.drop("place")


def curve_points(blocks: DataFrame) -> DataFrame:
    """x and y of the step curve: both ends of every block, at its bad rate."""
    y = F.col("bads") / F.col("n")
    ends = F.when(F.col("lo") < F.col("hi"), F.array("lo", "hi")).otherwise(F.array("lo"))
    return blocks.select(F.explode(ends).alias("x"), y.alias("y"))
