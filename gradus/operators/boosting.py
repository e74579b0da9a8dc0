"""Boosted trees on blocks of binned rows, grown on from where they stand.

The library's fit starts at its first round each time it is called, and a round of it costs microseconds a
row.  Here a row is one byte a feature: the place of its value among the candidate thresholds.
Rows travel in blocks with their margins; a level of a tree is one pass that adds residuals up per
(node, feature, byte), and only those sums reach the driver.  The method and its parameters are the
library's: trees of least variance on the residuals of the log loss, a draw of rows a round and of
features a node, thresholds between values of a sample.  The draws themselves are others.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.functions.columns import number
from gradus.operators.trees import ABSENT, Node, Trees
from gradus.sources.tables import materialise, staging_dir

#: Rows of a block, about, and blocks of a task.
BLOCK_ROWS, BLOCKS = 32_768, 64
#: Rows from which candidate thresholds are taken; the library takes 10,000.
SAMPLE = 100_000
#: Thresholds of a feature, one less than the library's default number of bins.
CUTS = 31
#: Rounds after which blocks are written with their margins; a lost executor costs no more rounds than these.
KEPT_ROUNDS = 32
#: The cut of a node without children: no byte is above it.
CLOSED = 255


def thresholds(values: np.ndarray, cuts: int = CUTS) -> np.ndarray:
    """Candidates as the library places them: between all values if few, else where a share of the rows ends."""
    found, counts = np.unique(values, return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= cuts:
        return between
    stride = len(values) / (cuts + 1)
    so_far, target, kept = np.cumsum(counts), stride, []
    for i in range(1, len(found)):
        if abs(so_far[i - 1] - target) < abs(so_far[i] - target):
            kept.append(between[i - 1])
            target += stride
    return np.array(kept[:cuts])


def features_asked(strategy: str, k: int) -> int:
    """Features drawn for a node, by the library's names of strategies for one tree."""
    named = {"all": k, "auto": k, "onethird": k / 3, "sqrt": math.sqrt(k), "log2": max(1.0, math.log2(k))}
    asked = named[strategy] if strategy in named else float(strategy) * (k if "." in strategy else 1)
    return min(k, math.ceil(asked))


def best_splits(counts: np.ndarray, sums: np.ndarray, asked: np.ndarray, least: int) -> list[tuple[int, int] | None]:
    """Per node (feature, byte that goes left last) of the largest fall in variance, None where there is none.

    ``counts`` and ``sums`` are node x feature x byte, ``asked`` node x feature: the features drawn.
    """
    n, s = counts[:, :1].sum(2, keepdims=True), sums[:, :1].sum(2, keepdims=True)
    left, below = counts.cumsum(2), sums.cumsum(2)
    right, above = n - left, s - below
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (below**2 / left + above**2 / right - s**2 / n) / n
    gain = np.where((left >= max(least, 1)) & (right >= max(least, 1)) & asked[:, :, None], gain, -1.0)
    out = []
    for g in gain:
        feature, byte = np.unravel_index(int(g.argmax()), g.shape)
        out.append((int(feature), int(byte)) if g[feature, byte] > 1e-15 else None)
    return out


class Boosting:
    """A boosted model that is grown by rounds; ``losses`` has the log loss on ``valid`` after each."""

    def __init__(
        self, train: DataFrame, valid: DataFrame, features: list[str], label: Column, max_depth: int, step: float, subsample: float, column_sample: str,
        min_instances: int, seed: int,
    ):
        self.spark, self.features, self.depth, self.step = train.sparkSession, list(features), max_depth, step
        self.subsample, self.columns, self.least, self.seed = subsample, features_asked(column_sample, len(features)), min_instances, seed
        self.trees: list[list[Node]] = []
        self.losses: list[float] = []
        filled = [F.coalesce(number(f), F.lit(ABSENT)).alias(f"f{i}") for i, f in enumerate(features)]
        rows, held_out = (df.select(*filled, label.cast("double").alias("y")) for df in (train, valid))
        n = rows.count()
        sampled = rows.sample(fraction=min(1.0, SAMPLE / max(n, 1)), seed=seed).toArrow()
        self.cuts = [thresholds(sampled[f"f{i}"].to_numpy()) for i in range(len(features))]
        blocks = materialise(self._packed(rows, False).unionByName(self._packed(held_out, True)))
        placed = blocks.rdd.map(tuple).zipWithIndex()
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-blocks.count() // BLOCKS))
        self.state = placed.map(lambda x: (x[1], x[0])).partitionBy(tasks, lambda at: at).values().mapPartitions(self._opened())
        self._advance(None, 0.0)

    def _packed(self, rows: DataFrame, valid: bool) -> DataFrame:
        """Blocks of at most ``BLOCK_ROWS`` rows: bytes of every feature and labels -1 and 1."""
        cuts, size = self.cuts, BLOCK_ROWS

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def block(tables: list[pa.RecordBatch], at: int) -> pa.RecordBatch:
                table = pa.Table.from_batches(tables)
                y = table["y"].to_numpy()
                if not ((y == 0) | (y == 1)).all():
                    raise ValueError("labels must be 0 or 1")
                bins = [np.searchsorted(c, table[f"f{i}"].to_numpy()).astype(np.uint8).tobytes() for i, c in enumerate(cuts)]
                # The number goes along with the block, so that its draws are the same when it is read again.
                parts = [pa.array([TaskContext.get().partitionId() * 2**24 + at], pa.int64()), pa.array([valid]), pa.array([b"".join(bins)], pa.binary()), pa.array([(2 * y - 1).astype(np.int8).tobytes()], pa.binary())]
                return pa.RecordBatch.from_arrays(parts, names=["block", "valid", "bins", "labels"])

            held, at = [], 0
            for batch in batches:
                while batch.num_rows:
                    room = size - sum(b.num_rows for b in held)
                    held, batch = [*held, batch.slice(0, room)], batch.slice(room)
                    if sum(b.num_rows for b in held) == size:
                        yield block(held, at)
                        held, at = [], at + 1
            if held:
                yield block(held, at)

        return rows.mapInArrow(packed, "block long, valid boolean, bins binary, labels binary")

    @staticmethod
    def _opened():
        def opened(blocks):
            for block, valid, bins, labels in blocks:
                y = np.frombuffer(labels, dtype=np.int8)
                yield block, valid, np.frombuffer(bins, dtype=np.uint8).reshape(-1, len(y)), y, np.zeros(len(y)), None, None

        return opened

    @staticmethod
    def _walk():
        def walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
            """Node of each row; the children of node k are 2k and 2k + 1, and the root is 1."""
            node = np.ones(bins.shape[1], dtype=np.uint8 if depth < 8 else np.uint32)
            for level in range(depth):
                right = np.zeros(bins.shape[1], dtype=bool)
                for k in range(2**level, 2 ** (level + 1)):
                    if cut[k] < 255:
                        right |= (node == k) & (bins[feature[k]] > cut[k])
                node = 2 * node + right
            return node.astype(np.intp)

        return walk

    def _advance(self, grown: tuple[np.ndarray, np.ndarray, np.ndarray] | None, weight: float) -> None:
        """Add a tree to the margins, draw the next round's rows and start its tree with the sums at the root."""
        walk, depth, first, share, key = self._walk(), self.depth, grown is None, self.subsample, (self.seed, len(self.trees))

        def advanced(blocks):
            for block, valid, bins, y, margin, _, _ in blocks:
                if not first:
                    feature, cut, value = grown
                    margin = margin + weight * value[walk(bins, feature, cut, depth)]
                if valid:
                    yield block, valid, bins, y, margin, None, None
                    continue
                residual = y.astype(np.float64) if first else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
                yield block, valid, bins, y, margin, residual, np.random.default_rng([*key, block]).random(len(y)) < share

        before, self.state = self.state, self.state.mapPartitions(advanced).persist(StorageLevel.MEMORY_AND_DISK)
        if len(self.trees) % KEPT_ROUNDS == KEPT_ROUNDS - 1:
            # Written, so that what is recomputed after a loss does not grow with the rounds.
            path = f"{staging_dir(self.spark).rstrip('/')}/rounds-{uuid.uuid4().hex}"
            self.state.saveAsPickleFile(path, 1)
            self.state.unpersist()
            self.state = self.spark.sparkContext.pickleFile(path).persist(StorageLevel.MEMORY_AND_DISK)
        self.root = self._sums(None, None, 0)
        before.unpersist()
        if not first:
            self.losses.append(self.root[2] / self.root[3] if self.root[3] else math.nan)

    def _sums(self, feature: np.ndarray | None, cut: np.ndarray | None, level: int) -> tuple[np.ndarray, np.ndarray, float, int]:
        """Rows and residuals per (node of the level, feature, byte); at the root also loss and number of the rows held out."""
        walk, width, nodes = self._walk(), CUTS + 1, 2**level

        def summed(blocks):
            counts, sums, loss, n = 0.0, 0.0, 0.0, 0
            for _, valid, bins, y, margin, residual, drawn in blocks:
                if valid:
                    if level == 0:
                        loss, n = loss + 2.0 * float(np.logaddexp(0.0, -2.0 * y * margin).sum()), n + len(y)
                    continue
                at = (walk(bins, feature, cut, level) - nodes if level else 0) * width
                at, size = np.where(drawn, at, nodes * width), (nodes + 1) * width
                cells = [at + b for b in bins]
                counts = counts + np.array([np.bincount(c, minlength=size) for c in cells])
                sums = sums + np.array([np.bincount(c, weights=residual, minlength=size) for c in cells])
            yield counts, sums, loss, n

        tasks = self.state.getNumPartitions()
        found = self.state.mapPartitions(summed).treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b)), depth=1 if tasks <= 256 else 2)
        shape = (len(self.features), nodes + 1, width)
        by_node = lambda x: (np.zeros(shape) + np.reshape(x, shape if np.ndim(x) else ())).transpose(1, 0, 2)[:nodes]
        return by_node(found[0]), by_node(found[1]), found[2], found[3]

    def _grow(self) -> None:
        """One more round."""
        size, k = 2 ** (self.depth + 1), len(self.features)
        feature, cut, value = np.zeros(size, dtype=np.intp), np.full(size, CLOSED), np.zeros(size)
        draw = np.random.default_rng([self.seed, len(self.trees), 2**40])
        open_nodes = {1}
        n, s = self.root[0][0, 0].sum(), self.root[1][0, 0].sum()
        value[1] = s / n if n else 0.0
        for level in range(self.depth):
            nodes = 2**level
            value[2 * nodes : 4 * nodes] = np.repeat(value[nodes : 2 * nodes], 2)  # a closed node hands its value down
            if not open_nodes:
                continue
            counts, sums, _, _ = self._sums(feature, cut, level) if level else self.root
            asked = np.zeros((nodes, k), dtype=bool)
            for row in asked:
                row[draw.choice(k, self.columns, replace=False)] = True
            below: set[int] = set()
            for node, split in enumerate(best_splits(counts, sums, asked, self.least), start=nodes):
                if split is None or node not in open_nodes:
                    continue
                f, byte = split
                feature[node], cut[node] = f, byte
                c, t = counts[node - nodes, f], sums[node - nodes, f]
                value[2 * node], value[2 * node + 1] = t[: byte + 1].sum() / c[: byte + 1].sum(), t[byte + 1 :].sum() / c[byte + 1 :].sum()
                below |= {2 * node, 2 * node + 1}
            open_nodes = below
        self.trees.append(self._nodes(feature, cut, value))
        self._advance((feature, cut, value), 1.0 if len(self.trees) == 1 else self.step)

    def _nodes(self, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> list[Node]:
        nodes: list[Node] = []

        def add(k: int) -> int:
            at = len(nodes)
            if cut[k] == CLOSED:
                nodes.append(Node(value=float(value[k])))
                return at
            nodes.append(Node())
            left = add(2 * k)
            nodes[at] = Node(self.features[feature[k]], float(self.cuts[feature[k]][cut[k]]), left, add(2 * k + 1))
            return at

        add(1)
        return nodes

    def to(self, rounds: int) -> list[float]:
        """Grow on to so many rounds; the losses of all of them."""
        while len(self.trees) < rounds:
            self._grow()
        return self.losses

    def model(self, rounds: int) -> Trees:
        """The model as it was after ``rounds`` rounds; no more are grown after this."""
        self.state.unpersist()
        return Trees(self.features, self.trees[:rounds], [1.0, *[self.step] * (rounds - 1)][:rounds])
