"""Boosted trees as a table of nodes, scored by expressions.

A fitted model becomes rows (tree, node, feature, threshold, children, value).  To score a
book every tree is one CASE expression over the feature columns, so scoring needs no model
object, no vector and no Python, and a column may be swapped for another in the same pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions.columns import literal, number, quoted

#: What stands for a missing value: left of every other one, so that a split can set it apart.
ABSENT = -1.0e12
#: Trees whose values are added in one expression.
TREES_AT_ONCE = 2
NODE_SCHEMA = "tree int, node int, feature string, threshold double, left int, right int, value double, weight double"

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_TREE = re.compile(r"Tree \d+ \(weight (\S+)\):")


@dataclass(frozen=True)
class Node:
    """A split (feature, threshold, places of both children in the tree) or a leaf (value)."""

    feature: str | None = None
    threshold: float | None = None
    left: int | None = None
    right: int | None = None
    value: float | None = None


def _read(lines: Iterator[str], features: list[str], nodes: list[Node]) -> int:
    """Nodes of one printed (sub)tree; the place of its root."""
    line = next(lines)
    at = len(nodes)
    split = _SPLIT.match(line)
    if not split:
        nodes.append(Node(value=float(line.removeprefix("Predict: "))))
        return at
    nodes.append(Node())
    left = _read(lines, features, nodes)
    next(lines)  # the line that says "Else"
    nodes[at] = Node(features[int(split[1])], float(split[2]), left, _read(lines, features, nodes))
    return at


@dataclass(frozen=True)
class Trees:
    """Trees of a two-class boosted model with their weights; a root is the first node of its tree."""

    features: list[str]
    trees: list[list[Node]]
    weights: list[float]

    @classmethod
    def of(cls, model: GBTClassificationModel, features: list[str]) -> Trees:
        """From the model's own printed form, which has every number in full."""
        lines = iter([line.strip() for line in model.toDebugString.splitlines() if line.strip()])
        trees: list[list[Node]] = []
        weights: list[float] = []
        for line in lines:
            if head := _TREE.match(line):
                weights.append(float(head[1]))
                trees.append([])
                _read(lines, features, trees[-1])
        return cls(list(features), trees, weights)

    def first(self, rounds: int) -> Trees:
        """The model as it was after ``rounds`` rounds."""
        return Trees(self.features, self.trees[:rounds], self.weights[:rounds])

    # --- as a table -----------------------------------------------------------------------
    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (t, i, n.feature, n.threshold, n.left, n.right, n.value, self.weights[t]) for t, nodes in enumerate(self.trees) for i, n in enumerate(nodes)
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @classmethod
    def from_frame(cls, nodes: DataFrame, features: list[str]) -> Trees:
        trees: dict[int, list[Node]] = {}
        weights: dict[int, float] = {}
        for r in sorted(nodes.collect(), key=lambda r: (r["tree"], r["node"])):
            trees.setdefault(r["tree"], []).append(Node(r["feature"], r["threshold"], r["left"], r["right"], r["value"]))
            weights[r["tree"]] = r["weight"]
        return cls(list(features), list(trees.values()), list(weights.values()))

    # --- scoring --------------------------------------------------------------------------
    def _case(self, nodes: list[Node], at: int, weight: float) -> str:
        n = nodes[at]
        if n.feature is None:
            return literal(n.value * weight)
        name = quoted(f"_f{self.features.index(n.feature)}")
        return f"CASE WHEN {name} <= {literal(n.threshold)} THEN {self._case(nodes, n.left, weight)} ELSE {self._case(nodes, n.right, weight)} END"

    def margin(self, df: DataFrame, out: str) -> DataFrame:
        """Add the weighted sum of the trees' values.

        Sums of a few trees go into an array, one element each, because the elements of an array
        are compiled into functions of their own; one long sum would be a single function, too
        large to be compiled.  The array is named twice below, which keeps the optimizer from
        putting it back into the sum.
        """
        filled = df.withColumns({f"_f{i}": F.coalesce(number(f), F.lit(ABSENT)) for i, f in enumerate(self.features)})
        cases = [self._case(nodes, 0, w) for nodes, w in zip(self.trees, self.weights)]
        groups = [" + ".join(f"({c})" for c in cases[i : i + TREES_AT_ONCE]) for i in range(0, len(cases), TREES_AT_ONCE)]
        summed = filled.withColumn("_sums", F.array(*[F.expr(g) for g in groups] or [F.lit(0.0)]))
        whole = F.when(F.size("_sums") > 0, F.aggregate("_sums", F.lit(0.0), lambda a, x: a + x))
        return summed.withColumn(out, whole).drop("_sums", *[f"_f{i}" for i in range(len(self.features))])

    def probability(self, margin: Column) -> Column:
        """Probability of class 1; the margin of the log loss is half the log-odds."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))
