"""Multinomial logistic fit on rows that share texts.

A row's margins are those of its text plus those of its own few columns.  Rows are dealt to blocks
by text, so that a block holds the vector of each of its texts once; a pass works out a text's
margins once, repeats them over its rows, and adds the rows' residuals up before they meet the
vector.  It costs rows x columns x classes, plus cells of distinct texts x classes, where one vector
a row costs rows x grams x classes.  The likelihood, the penalty and the gradient are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from gradus.sources.tables import materialise

#: Rows of a block, about; a text with more is dealt to several blocks.
BLOCK_ROWS = 8_192
#: Steps that the search direction remembers.
MEMORY = 10
_BLOCK = "labels binary, columns binary, rows_per_text binary, cells_per_text binary, positions binary, weights binary, by_position binary"


def text_blocks(rows: DataFrame, cells: DataFrame, label: Column, columns: list[Column], block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """Written blocks of ``rows`` and their number of rows.

    ``cells`` has described, positions and weights, one row a text.  A row without a text, or whose text has
    no cells, has its columns only.  A label that is null and a column that is NaN or infinite are refused,
    a column that is null counts as 0.
    """
    names = [f"c{i}" for i in range(len(columns))]
    known = F.coalesce(label.cast("int"), F.raise_error(F.lit("a row without a class")).cast("int"))
    # The draw is written with the row, so a row that is read again goes to the same block.
    held = materialise(rows.select("description", known.alias("label"), *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in zip(names, columns)], F.rand(7).alias("draw")))
    counts = materialise(held.groupBy(F.col("description").alias("described")).agg(F.count(F.lit(1)).alias("n")))
    n = counts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-n // block_rows))
    piece = F.floor(F.col("draw") * F.ceil(F.col("n") / F.lit(max(1, block_rows // 4))))
    placed = held.join(counts, F.col("description").eqNullSafe(F.col("described"))).select(
        F.pmod(F.xxhash64("described", piece), F.lit(blocks)).alias("block"), "described", "label", *names
    )
    texts = placed.select(F.col("block").alias("at"), F.col("described").alias("text")).distinct().join(cells, F.col("text") == cells["described"]).select("at", "text", "positions", "weights")

    def pack(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, place = right.num_rows, pc.index_in(left["described"].combine_chunks(), value_set=right["text"].combine_chunks())
        owner = np.asarray(place.fill_null(texts))  # rows without cells come last
        order = np.argsort(owner, kind="stable")
        own = np.array([np.asarray(left[c].combine_chunks())[order] for c in names]).reshape(len(names), len(order))
        if not np.isfinite(own).all():
            raise ValueError("values must not be NaN or infinite")
        positions, weights = (np.asarray(pc.list_flatten(right[c].combine_chunks())) for c in ("positions", "weights"))
        out = (
            np.asarray(left["label"].combine_chunks())[order].astype(np.int32), own.astype(np.float64), np.bincount(owner, minlength=texts + 1).astype(np.int64),
            np.asarray(pc.list_value_length(right["positions"].combine_chunks())).astype(np.int64), positions.astype(np.int32), weights.astype(np.float64),
            np.argsort(positions, kind="stable").astype(np.int32),
        )
        return pa.table({part.split()[0]: pa.array([x.tobytes()], pa.binary()) for part, x in zip(_BLOCK.split(", "), out)})

    return materialise(placed.groupBy("block").cogroup(texts.groupBy("at")).applyInArrow(pack, _BLOCK)), n


def summed_over(blocks: DataFrame, weights: np.ndarray, width: int) -> tuple[float, np.ndarray]:
    """Log loss summed over all rows, and its gradient.

    ``weights`` has a row per class; its columns are text positions, then the rows' ``width`` own columns,
    then the intercept.
    """
    classes, size = weights.shape[0], weights.shape[1] - width - 1
    sent = blocks.sparkSession.sparkContext.broadcast(weights)

    def passed(held: Iterator[Row]) -> Iterator[np.ndarray]:
        w = sent.value
        # The loss goes along as one more place.
        total = np.zeros((classes, w.shape[1] + 1))
        for block in held:
            kinds = (np.int32, np.float64, np.int64, np.int64, np.int32, np.float64, np.int32)
            labels, own, rows, cells, positions, values, by_position = (np.frombuffer(x, dtype=k) for x, k in zip(block, kinds))
            own, every, texts = own.reshape(width, len(labels)), np.arange(len(labels)), len(cells)
            margins = np.zeros((classes, texts + 1))
            if texts:
                margins[:, :texts] = np.add.reduceat(w[:, positions] * values, np.cumsum(cells) - cells, axis=1)
            z = np.repeat(margins, rows, axis=1) + w[:, size:-1] @ own + w[:, -1:]
            z -= z.max(axis=0)
            total[0, -1] -= z[labels, every].sum()
            np.exp(z, out=z)
            s = z.sum(axis=0)
            total[0, -1] += np.log(s).sum()
            z /= s
            z[labels, every] -= 1.0
            total[:, size:-2] += z @ own.T
            total[:, -2] += z.sum(axis=1)
            if texts:
                residual = np.add.reduceat(z[:, : len(labels) - rows[-1]], (np.cumsum(rows) - rows)[:-1], axis=1)
                spread = (np.repeat(residual, cells, axis=1) * values)[:, by_position]
                ordered = positions[by_position]
                starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
                total[:, ordered[starts]] += np.add.reduceat(spread, starts, axis=1)
        yield total

    found = blocks.rdd.mapPartitions(passed).treeReduce(np.add)
    sent.destroy()
    return float(found[0, -1]), found[:, :-1]


def minimised(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int, tol: float = 1e-6) -> tuple[np.ndarray, int]:
    """Least point of a smooth convex function, and the rounds taken, by limited-memory BFGS.

    It ends as the library's logistic fit does: once the last ten rounds lowered the value by less
    than ``tol`` of the first one, or the gradient is as small.
    """
    x, (value, g) = start, evaluate(start)
    first, values, steps, changes = value, [value], [], []
    for rounds in range(max_iter):
        if np.linalg.norm(g) <= max(tol * value, 1e-8):
            return x, rounds
        direction, kept = -g, []
        for s, y in zip(reversed(steps), reversed(changes)):
            a = (s @ direction) / (s @ y)
            direction = direction - a * y
            kept.append(a)
        if steps:
            direction = direction * ((steps[-1] @ changes[-1]) / (changes[-1] @ changes[-1]))
        for s, y, a in zip(steps, changes, reversed(kept)):
            direction = direction + (a - (y @ direction) / (s @ y)) * s
        slope, low, high = g @ direction, 0.0, np.inf
        step = 1.0 if steps else min(1.0, 1.0 / np.linalg.norm(g))
        for _ in range(30):  # bisection until the value fell enough and the slope flattened
            nearby = x + step * direction
            there, gradient = evaluate(nearby)
            if not there <= value + 1e-4 * step * slope:
                high = step
            elif gradient @ direction < 0.9 * slope:
                low = step
            else:
                break
            step = (low + high) / 2 if np.isfinite(high) else 2 * step
        else:
            if not there < value:
                return x, rounds  # no lower point within the precision of the numbers
        steps, changes = [*steps, nearby - x][-MEMORY:], [*changes, gradient - g][-MEMORY:]
        x, value, g = nearby, there, gradient
        if max(values) - value <= tol * first:
            return x, rounds + 1
        values = [*values, value][-MEMORY:]
    return x, max_iter


def fit_softmax(blocks: DataFrame, n: int, deviations: np.ndarray, means: np.ndarray, width: int, priors: np.ndarray, penalty: float, max_iter: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Weights (class x place), intercepts and rounds of the least penalised mean log loss.

    The search runs on places of unit deviation around their means, as the library's does; the penalty is on the
    weights themselves, not on intercepts.  A place that never varies has no weight.
    """
    classes = len(priors)
    scale = np.divide(1.0, deviations, out=np.zeros_like(deviations), where=deviations > 0)

    def weights_of(v: np.ndarray) -> np.ndarray:
        v = v.reshape(classes, -1)
        w = v[:, :-1] * scale
        return np.c_[w, v[:, -1] - w @ means]

    def evaluate(v: np.ndarray) -> tuple[float, np.ndarray]:
        w = weights_of(v)
        loss, gradient = summed_over(blocks, w, width)
        inner = (gradient[:, :-1] - gradient[:, -1:] * means) / n + penalty * w[:, :-1]
        return loss / n + 0.5 * penalty * float((w[:, :-1] ** 2).sum()), np.c_[inner * scale, gradient[:, -1] / n].ravel()

    base = np.log(priors)
    found, rounds = minimised(evaluate, np.c_[np.zeros((classes, len(scale))), base - base.mean()].ravel(), max_iter)
    w = weights_of(found)
    return w[:, :-1], w[:, -1] - w[:, -1].mean(), rounds
