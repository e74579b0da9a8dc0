"""Hard negatives: rows of another label that score just below an anchor's positives.

Rows are dealt to blocks by their id, anchors to blocks of bounded size, and every block of
anchors meets every block of rows (anchors are a stated query set against all rows).  The
anchors of a block form a spanning tree.  For a parent p, a child c and a row x,

    <c, x> = <p, x> + <c - p, x>,   |<c - p, x>| <= |c - p| * |x|,

so what is known of a row's score at the parent, widened by the edge's length times the row's
norm, bounds its score at the child.  Only rows whose bounds overlap what the child looks for
are scored again, which narrows their bounds to a point for the child's own children.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.llm.workers import in_arrow, ship
from gradus.sources.tables import materialise

ROWS_PER_BLOCK = 1 << 18
ANCHORS_PER_BLOCK = 1 << 15
#: Blocks of rows there are at least, so that small tables are spread as well.
LEAST_BLOCKS = 64
#: Rows of a block whose bounds are held at a time, for each anchor on the way from the root.
ROWS_AT_ONCE = 4_096
#: Edges between the root and an anchor at most.
DEEPEST = 48
#: Sums of products up to here are exact in doubles.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1

_PACKED = "dim int, vec_id long, label long, is_anchor boolean, vec binary"
_TREE = "dim int, b int, place int, parent int, edge double, vec_id long, label long, vec binary"
_FOUND = "dim int, anchor_id long, positive_id long, positive_score long, vec_id long, score long"


# --- vectors ------------------------------------------------------------------------------
def packed(vectors: DataFrame, anchors: Column, scale: int) -> DataFrame:
    """Rows that take part, their components times ``scale`` rounded down, as packed numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(over="ignore"):
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            ends = np.cumsum(sizes)
            odd = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            wide = np.concatenate(([0], np.cumsum(~(np.abs(flat) <= 32_767))))
            whole = (odd[ends] == odd[ends - sizes]) & pc.is_valid(lists).to_numpy(zero_copy_only=False)
            narrow = np.where(np.abs(flat) <= 32_767, flat, 0).astype("<i2").tobytes()
            out = [None] * len(sizes)
            for i in np.flatnonzero(whole).tolist():
                lo, hi = int(ends[i] - sizes[i]), int(ends[i])
                out[i] = flat[lo:hi].astype("<f8").tobytes() if wide[hi] > wide[lo] else narrow[2 * lo : 2 * hi]
            cells = [pa.array(sizes.astype(np.int32)), *(batch.column(c) for c in ("vec_id", "label", "is_anchor")), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=["dim", "vec_id", "label", "is_anchor", "vec"]).filter(pa.array(whole))

    named = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"), F.col("embedding").alias("embedding")
    )
    return in_arrow(named.where("vec_id is not null and label is not null and embedding is not null"), run, _PACKED)


def numbers(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Matrix of packed vectors; whole numbers, held as doubles."""
    rows = column.to_pylist()
    if all(len(v) == 2 * dim for v in rows):
        return np.frombuffer(b"".join(rows), "<i2").reshape(len(rows), dim).astype(np.float64)
    return np.stack([np.frombuffer(v, "<i2" if len(v) == 2 * dim else "<f8").astype(np.float64) for v in rows])


def products(x: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as longs; beyond the range of a long they stay at its ends."""
    if exact:
        return (x @ anchor).astype(np.int64)
    whole = [int(v) for v in anchor]
    sums = (sum(int(v) * w for v, w in zip(row, whole)) for row in x.tolist())
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in sums], dtype=np.int64)


# --- the tree -----------------------------------------------------------------------------
def spanning_tree(vectors: np.ndarray, deepest: int = DEEPEST) -> tuple[np.ndarray, np.ndarray]:
    """Each anchor's parent, the nearest one before it that is not too deep, and the edge's length; -1 for the root."""
    n = len(vectors)
    parent, depth = np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.int32)
    squares = (vectors * vectors).sum(axis=1)
    shallow = np.zeros(n)
    for lo in range(0, n, 1_024):
        hi = min(lo + 1_024, n)
        apart = squares[:hi] - 2 * (vectors[lo:hi] @ vectors[:hi].T)
        for i in range(max(lo, 1), hi):
            parent[i] = np.argmin(apart[i - lo, :i] + shallow[:i])
            depth[i] = depth[parent[i]] + 1
            if depth[i] >= deepest:
                shallow[i] = np.inf
    edges = np.zeros(n)
    edges[1:] = np.sqrt(((vectors[1:] - vectors[parent[1:]]) ** 2).sum(axis=1))
    return parent, edges


def _planted(anchors: DataFrame) -> DataFrame:
    """Anchors of each block (dim, b) in an order that has parents before their children."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        vectors = numbers(table.column("vec"), table.column("dim")[0].as_py())
        with np.errstate(over="ignore", invalid="ignore"):
            parent, edges = spanning_tree(vectors)
        cells = [table.column("dim"), table.column("b"), pa.array(np.arange(len(parent), dtype=np.int32)), pa.array(parent), pa.array(edges), *(table.column(c) for c in ("vec_id", "label", "vec"))]
        return pa.Table.from_arrays(cells, names=["dim", "b", "place", "parent", "edge", "vec_id", "label", "vec"])

    ship(anchors.sparkSession)
    return anchors.groupBy("dim", "b").applyInArrow(run, _TREE)


class Best:
    """The first ``n`` of what was offered, by score descending, then id."""

    def __init__(self, n: int, low: int = -_LONG - 1, high: int = _LONG):
        self.n, self.low, self.high = n, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """Below this score nothing is taken any more."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.n else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.least()) & (scores <= self.high)
        scores, ids = np.concatenate((self.scores, scores[fits])), np.concatenate((self.ids, ids[fits]))
        first = np.lexsort((ids, ~scores))[: self.n]  # ~s is -s - 1, which has no overflow
        self.scores, self.ids = scores[first], ids[first]


def descend(x: np.ndarray, anchors: np.ndarray, parent: np.ndarray, edges: np.ndarray, exact: bool, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray], found: Callable[[int, np.ndarray, np.ndarray], None]) -> int:
    """Go through the tree from the root; how many scores were worked out.

    ``wanted(place, low, high)`` says which rows may matter to an anchor, given bounds of
    their scores; ``found(place, rows, scores)`` gets the scores of those.
    """
    with np.errstate(over="ignore"):
        norms = np.sqrt((x * x).sum(axis=1))
    children: list[list[int]] = [[] for _ in parent]
    for i in range(1, len(parent)):
        children[parent[i]].append(i)
    everything = np.arange(len(x))
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    scored, todo = 0, [0]
    while todo:
        place = todo.pop()
        if place < 0:  # the children of this anchor are done
            del held[~place]
            continue
        if parent[place] < 0 or not exact:
            rows, low, high = everything, np.zeros(len(x)), np.zeros(len(x))
        else:
            reach = np.ceil(edges[place] * norms * (1 + 1e-9) + 1e-6)
            above, below = held[parent[place]]
            low, high = above - reach, below + reach
            rows = np.flatnonzero(wanted(place, low, high))
        scores = products(x[rows], anchors[place], exact)
        scored += len(rows)
        low[rows] = high[rows] = scores
        if len(rows) == len(x):
            keep = wanted(place, low, high)
            found(place, rows[keep], scores[keep])
        else:
            found(place, rows, scores)
        if children[place]:
            held[place] = (low, high)
            todo.append(~place)
            todo += children[place]
    return scored


# --- the search ---------------------------------------------------------------------------
def _search(n_positives: int, n_negatives: int, percent: int | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block of rows against a block of anchors: positives, or negatives where ``percent`` is given."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            dim = anchors.column("dim")[0].as_py()
            anchors = anchors.sort_by("place")
            names, kinds, parent, edges = (anchors.column(c).to_numpy() for c in ("vec_id", "label", "parent", "edge"))
            vectors = numbers(anchors.column("vec"), dim)
            first = sorted(zip(rows.column("vec_id").to_pylist(), rows.column("label").to_pylist(), rows.column("vec").to_pylist(), range(rows.num_rows)))
            rows = rows.take([r[3] for i, r in enumerate(first) if not i or r[0] != first[i - 1][0]])
            ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
            if percent is None:
                best = [[Best(n_positives)] for _ in names]
                slots = [[(None, None)]] * len(names)
            else:
                slots = [[(p["id"], p["score"]) for p in own] for own in anchors.column("positives").to_pylist()]
                best = [[Best(n_negatives, -(-percent * score // 100), score) for _, score in own] for own in slots]
            largest = float(np.abs(vectors).max(initial=0))
            for lo in range(0, len(ids), ROWS_AT_ONCE):
                x = numbers(rows.column("vec").slice(lo, ROWS_AT_ONCE), dim)
                own_ids, own_labels = ids[lo : lo + ROWS_AT_ONCE], labels[lo : lo + ROWS_AT_ONCE]
                size = max(largest, float(np.abs(x).max(initial=0)))
                exact = size * size * 4 * max(dim, 1) < _EXACT

                def wanted(place: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                    of_label = (own_labels == kinds[place]) & (own_ids != names[place]) if percent is None else own_labels != kinds[place]
                    least = min((b.least() for b in best[place]), default=_LONG)
                    most = max((b.high for b in best[place]), default=-_LONG)
                    return of_label & (high >= least) & (low <= most)

                def found(place: int, at: np.ndarray, scores: np.ndarray) -> None:
                    for b in best[place]:
                        b.offer(scores, own_ids[at])

                descend(x, vectors, parent, edges, exact, wanted, found)
            for name, own, kept in zip(names.tolist(), slots, best):
                for (positive, score), b in zip(own, kept):
                    out += [(dim, name, positive, score, i, s) for i, s in zip(b.ids.tolist(), b.scores.tolist())]
        kinds_of = (pa.int32(), *[pa.int64()] * 5)
        cells = list(zip(*out)) or [()] * 6
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds_of)], names=["dim", "anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    return run


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, percent: int = 80, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and embedding; rows for which ``anchors`` is true are anchors
    too.  Components count as ``floor(scale * x)``, a score is the inner product of those with
    the anchor's, and higher scores come first, then smaller ids.  Positives of an anchor are
    the first ``positives`` other rows of its label; for each of them, the result has the
    first ``negatives`` rows of another label with ``percent * positive_score <= 100 *
    negative_score <= 100 * positive_score``.

    A row with a null id, label, vector or component, or a component that is not finite (also
    once scaled), takes no part.  Rows of one id and length are one row, the first by label
    and vector.  Vectors of different length don't meet.  A score beyond a long stays at its end.
    """
    rows = materialise(packed(vectors, anchors, scale))
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    row_blocks = max(LEAST_BLOCKS, math.ceil(n_rows / ROWS_PER_BLOCK))
    anchor_blocks = max(1, math.ceil(n_anchors / ANCHORS_PER_BLOCK))

    one_each = rows.where("is_anchor").groupBy("dim", "vec_id").agg(F.min(F.struct("label", "vec")).alias("first")).select("dim", "vec_id", "first.label", "first.vec")
    tree = materialise(_planted(one_each.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(anchor_blocks)).cast("int"))))
    dealt = rows.select("dim", "vec_id", "label", "vec", F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("b"))
    key = ["dim", "b", "r"]

    def met(blocks: DataFrame, percent: int | None) -> DataFrame:
        sent = blocks.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
        return dealt.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(_search(positives, negatives, percent), _FOUND)

    order = [F.col("score").desc(), F.col("vec_id")]
    of_anchor = Window.partitionBy("dim", "anchor_id").orderBy(*order)
    near = met(tree, None).withColumn("rank", F.row_number().over(of_anchor)).where(F.col("rank") <= positives)
    own = near.groupBy("dim", "anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("vec_id").alias("id"), "score"))).alias("positives"))
    aimed = materialise(tree.join(own.select(F.col("dim").alias("d"), F.col("anchor_id").alias("a"), "positives"), (F.col("dim") == F.col("d")) & (F.col("vec_id") == F.col("a")), "left").drop("d", "a"))
    of_positive = Window.partitionBy("dim", "anchor_id", "positive_id").orderBy(*order)
    hard = met(aimed.withColumn("positives", F.coalesce("positives", F.array())), percent).withColumn("rank", F.row_number().over(of_positive)).where(F.col("rank") <= negatives)
    return hard.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
