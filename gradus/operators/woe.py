"""Weight of Evidence: coarse bins, monotone merging, transform.

Rows are touched twice: once for the quantiles, once for the counts per bin.  Everything
after that works on the bin table, which has features x bins rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions.columns import MISSING_BIN, bin_index, iv_strength, lookup_by_edge, number
from gradus.operators.ordering import melt, quantiles, rounded

MISSING_LABEL = "Missing"
BIN_SCHEMA = (
    "feature string, bin_index int, bin string, count long, goods long, bads long, "
    "bad_rate double, woe double, iv_contribution double"
)


@dataclass(frozen=True)
class Bin:
    index: int
    label: str
    goods: int
    bads: int
    woe: float
    iv: float

    @property
    def count(self) -> int:
        return self.goods + self.bads

    @property
    def bad_rate(self) -> float:
        return self.bads / max(self.count, 1)


@dataclass(frozen=True)
class FeatureBins:
    """Fitted bins of one feature: inner cut points, finite bins in order, Missing if seen."""

    feature: str
    edges: list[float]
    bins: list[Bin]

    @property
    def finite(self) -> list[Bin]:
        return [b for b in self.bins if b.index != MISSING_BIN]

    @property
    def woe(self) -> list[float]:
        return [b.woe for b in self.finite]

    @property
    def missing_woe(self) -> float:
        # Neutral when training saw no missing value, so scoring stays defined.
        return next((b.woe for b in self.bins if b.index == MISSING_BIN), 0.0)

    @property
    def information_value(self) -> float:
        return sum(b.iv for b in self.bins)


@dataclass(frozen=True)
class WoeBins:
    """Bins of all features; small, so it travels as literals inside expressions."""

    features: dict[str, FeatureBins] = field(default_factory=dict)

    def only(self, names: list[str]) -> WoeBins:
        """Fitting is per feature, so a subset needs no refit."""
        self.require(names)
        return WoeBins({n: self.features[n] for n in names})

    def require(self, names: list[str]) -> None:
        unknown = [n for n in names if n not in self.features]
        if unknown:
            raise KeyError(f"no fitted bins for {unknown}")

    def table(self, spark: SparkSession) -> DataFrame:
        """The published bin table."""
        rows = [
            (f.feature, b.index, b.label, b.count, b.goods, b.bads, b.bad_rate, b.woe, b.iv)
            for f in self.features.values() for b in f.bins
        ]
        return spark.createDataFrame(rows, BIN_SCHEMA)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per feature: the parameters that scoring needs."""
        rows = [(f.feature, f.edges, f.woe, f.missing_woe, f.information_value) for f in self.features.values()]
        return spark.createDataFrame(
            rows, "feature string, edges array<double>, woe array<double>, missing_woe double, information_value double"
        )

    @classmethod
    def from_frames(cls, params: DataFrame, table: DataFrame) -> WoeBins:
        edges = {r["feature"]: list(r["edges"]) for r in params.collect()}
        bins: dict[str, list[Bin]] = {f: [] for f in edges}
        for r in table.collect():
            bins[r["feature"]].append(Bin(r["bin_index"], r["bin"], r["goods"], r["bads"], r["woe"], r["iv_contribution"]))
        ordered = {f: sorted(bs, key=lambda b: (b.index == MISSING_BIN, b.index)) for f, bs in bins.items()}
        return cls({f: FeatureBins(f, edges[f], ordered[f]) for f in edges})


def coarse_edges(df: DataFrame, features: list[str], max_bins: int = 8) -> dict[str, list[float]]:
    """Inner quantile cut points (interpolated, 10 decimals, distinct); none for a constant."""
    inner = [i / max_bins for i in range(1, max_bins)]
    found = quantiles(df, features, [0.0, *inner, 1.0])
    edges = {}
    for f in features:
        cell = found.get((None, f))
        if cell is None or cell.n == 0 or cell.values[0.0] == cell.values[1.0]:
            edges[f] = []
        else:
            edges[f] = sorted(set(rounded([cell.values[p] for p in inner], 10)))
    return edges


def bin_counts(df: DataFrame, edges: dict[str, list[float]], target: str) -> DataFrame:
    """Rows, goods and bads per feature and bin: one pass, combined on the map side."""
    clean = df.select(F.col(target).cast("bigint").alias("_y"), *[number(f).alias(f) for f in edges])
    cells = {f: [bin_index(f, e)] for f, e in edges.items()}
    return (
        melt(clean, ["_y"], cells, ["bin_index"])
        .groupBy("feature", "bin_index")
        .agg(F.count(F.lit(1)).alias("count"), F.sum(1 - F.col("_y")).alias("goods"), F.sum("_y").alias("bads"))
    )


def _labels(edges: list[float]) -> list[str]:
    if not edges:
        return ["(-inf, inf)"]
    text = [f"{e:g}" for e in edges]
    return [f"(-inf, {text[0]}]", *[f"({a}, {b}]" for a, b in zip(text, text[1:])], f"({text[-1]}, inf)"]


def _fold(counts: np.ndarray, edges: list[float], left: int) -> tuple[np.ndarray, list[float]]:
    joined = np.vstack([counts[:left], counts[left : left + 2].sum(axis=0), counts[left + 2 :]])
    return joined, edges[:left] + edges[left + 1 :]


def merge_bins(counts: np.ndarray, edges: list[float], min_bin_fraction: float) -> tuple[np.ndarray, list[float]]:
    """Fold bins that are too small, then bins that break a monotone bad rate.

    ``counts`` is (bins, [good, bad]).  The first small bin joins its right neighbour (the
    last one its left).  The trend is fixed once, before the monotone step, which folds
    the worst offending pair until none is left.
    """
    smallest = max(1.0, min_bin_fraction * counts.sum())
    while len(counts) > 1:
        small = np.flatnonzero(counts.sum(axis=1) < smallest)
        if not small.size:
            break
        counts, edges = _fold(counts, edges, min(int(small[0]), len(counts) - 2))

    def rates() -> np.ndarray:
        return counts[:, 1] / np.maximum(counts.sum(axis=1), 1.0)

    trend = 1.0
    start = rates()
    if len(start) > 1 and not np.allclose(start, start[0]):
        r = np.corrcoef(np.arange(len(start), dtype=float), start)[0, 1]
        trend = -1.0 if r < 0 else 1.0
    while len(counts) > 1:
        steps = np.diff(rates()) * trend
        worst = int(np.argmin(steps))
        if steps[worst] >= 0:
            break
        counts, edges = _fold(counts, edges, worst)
    return counts, edges


def _feature_bins(feature, edges, finite, missing, total_good, total_bad, smoothing) -> FeatureBins:
    def make(index: int, label: str, good: float, bad: float) -> Bin:
        share_good = (good + smoothing) / (total_good + 2 * smoothing)
        share_bad = (bad + smoothing) / (total_bad + 2 * smoothing)
        woe = math.log(share_good / share_bad)
        return Bin(index, label, int(good), int(bad), woe, float((share_good - share_bad) * woe))

    bins = [make(i, label, *finite[i]) for i, label in enumerate(_labels(edges))]
    if missing.sum() > 0:
        bins.append(make(MISSING_BIN, MISSING_LABEL, *missing))
    return FeatureBins(feature, list(edges), bins)


def woe_fit(
    df: DataFrame,
    features: list[str],
    target: str,
    max_bins: int = 8,
    min_bin_fraction: float = 0.05,
    smoothing: float = 0.5,
    monotone: bool = True,
    edges: dict[str, list[float]] | None = None,
) -> WoeBins:
    """Fit WoE bins of every feature.  ``edges`` fixes the cut points; ``monotone=False``
    keeps the coarse bins as they are."""
    edges = coarse_edges(df, features, max_bins) if edges is None else {f: list(edges[f]) for f in features}
    return bins_of_counts(bin_counts(df, edges, target), edges, min_bin_fraction, smoothing, monotone)


def bins_of_counts(counted: DataFrame, edges: dict[str, list[float]], min_bin_fraction: float = 0.05, smoothing: float = 0.5, monotone: bool = True) -> WoeBins:
    """WoE bins from goods and bads per (feature, bin_index), features x (bins + 1) rows."""
    tally = {f: np.zeros((len(e) + 1, 2)) for f, e in edges.items()}
    missing = {f: np.zeros(2) for f in edges}
    for r in counted.collect():
        cell = np.array([r["goods"] or 0, r["bads"] or 0], dtype=float)
        if r["bin_index"] == MISSING_BIN:
            missing[r["feature"]] += cell
        else:
            tally[r["feature"]][r["bin_index"]] += cell
    fitted = {}
    for f in edges:
        total_good, total_bad = tally[f].sum(axis=0) + missing[f]
        if total_good == 0 or total_bad == 0:
            raise ValueError(f"feature {f!r}: the target has only one class")
        counts, cuts = (merge_bins(tally[f], edges[f], min_bin_fraction) if monotone else (tally[f], edges[f]))
        fitted[f] = _feature_bins(f, cuts, counts, missing[f], total_good, total_bad, smoothing)
    return WoeBins(fitted)


def woe_transform(df: DataFrame, bins: WoeBins, features: list[str] | None = None) -> DataFrame:
    """Add ``woe_<feature>`` columns: CASE expressions on literals, no join and no UDF."""
    features = list(bins.features) if features is None else features
    bins.require(features)
    numeric = df.withColumns({f"woe_{f}": number(f) for f in features})
    chosen = {f: bins.features[f] for f in features}
    return numeric.withColumns({f"woe_{f}": lookup_by_edge(f"woe_{f}", b.edges, b.woe, b.missing_woe) for f, b in chosen.items()})


def information_values(table: DataFrame) -> DataFrame:
    """IV per feature from a bin table, strongest first, with its conventional reading."""
    return (
        table.groupBy("feature")
        .agg(F.sum("iv_contribution").alias("information_value"))
        .withColumn("strength", iv_strength(F.col("information_value")))
        .orderBy(F.desc("information_value"), "feature")
    )


def top_information_values(table: DataFrame, n: int = 14) -> DataFrame:
    return information_values(table).limit(n)

