"""Feature selection: IV floor, degenerate features, correlated features."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions.columns import MISSING_BIN, iv_strength
from gradus.operators.features import TARGET
from gradus.operators.joint import bin_values, correlations, counts_by_bin, joint_bin_counts
from gradus.operators.woe import WoeBins, bins_of_counts, coarse_edges, information_values
from gradus.sources.tables import materialise

MIN_IV = 0.02
MAX_CORRELATION = 0.85
# Reasons as they are reported.
DEGENERATE = "single populated bin - no separation among observed values"
BELOW_FLOOR = "IV below floor"
CORRELATED = "correlated {:.2f} with {}"


def iv_floor(table: DataFrame, min_iv: float = MIN_IV) -> DataFrame:
    return information_values(table).where(F.col("information_value") >= min_iv)


def degenerate_features(table: DataFrame) -> DataFrame:
    """Features whose observed values share one bin, so only Missing separates anybody."""
    return (
        table.groupBy("feature")
        .agg(F.count_if(F.col("bin_index") != MISSING_BIN).alias("finite_bins"))
        .where(F.col("finite_bins") < 2)
    )


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, in one pass without a shuffle of rows.

    The sums of products are Spark's, merged in a tree; features x features numbers reach the
    driver.  A constant column has no correlation (NULL).  Columns must not be NULL.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    schema = "a string, b string, corr double"
    if not pairs or df.isEmpty():
        return df.sparkSession.createDataFrame([(columns[i], columns[j], None) for i, j in pairs], schema)
    wide = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    vectors = VectorAssembler(inputCols=wide.columns, outputCol="_x").transform(wide)
    matrix = Correlation.corr(vectors, "_x").first()[0].toArray()
    rows = [(columns[i], columns[j], None if math.isnan(matrix[i, j]) else float(matrix[i, j])) for i, j in pairs]
    return df.sparkSession.createDataFrame(rows, schema)


def prune_correlated(pairs: DataFrame, ranking: list[str], threshold: float = MAX_CORRELATION) -> tuple[list[str], dict[str, str]]:
    """Of features that correlate, those that no stronger survivor outranks, and why the others go.

    Each feature has its stronger rivals from the pair table, in rank order; the first rival
    that itself stays is the reason.  ``pairs`` is a features x features table; only that
    reaches the driver.
    """
    rank = {f: i for i, f in enumerate(ranking)}
    rivals: dict[str, list[tuple[int, float]]] = {f: [] for f in ranking}
    for row in pairs.where(F.abs("corr") >= threshold).collect():
        strong, weak = sorted((row["a"], row["b"]), key=lambda f: rank.get(f, len(rank)))
        if weak in rank:
            rivals[weak].append((rank[strong], abs(row["corr"])))
    dropped: dict[str, str] = {}
    for weak, met in rivals.items():
        standing = [(i, r) for i, r in sorted(met) if ranking[i] not in dropped]
        if standing:
            i, r = standing[0]
            dropped[weak] = CORRELATED.format(r, ranking[i])
    return [f for f in ranking if f not in dropped], dropped


@dataclass(frozen=True)
class Selection:
    selected: list[str]
    reasons: dict[str, str] = field(default_factory=dict)
    information_value: dict[str, float] = field(default_factory=dict)

    def report(self, spark: SparkSession) -> DataFrame:
        rows = [(f, iv, f in self.selected, self.reasons.get(f, "")) for f, iv in self.information_value.items()]
        base = spark.createDataFrame(rows, "feature string, information_value double, selected boolean, exclusion_reason string")
        return base.select("feature", "information_value", iv_strength(F.col("information_value")).alias("strength"), "selected", "exclusion_reason")


def select_features(
    train: DataFrame, bins: WoeBins, target: str = TARGET, min_iv: float = MIN_IV, max_correlation: float = MAX_CORRELATION
) -> Selection:
    """Selection among fitted bins, with one scan of ``train`` for the counts per pair of bins."""
    edges = {f: b.edges for f, b in bins.features.items()}
    return _selection(joint_bin_counts(train, edges, target), bins, edges, min_iv, max_correlation)


def fit_and_select(
    train: DataFrame, features: list[str], target: str, max_bins: int = 8, min_iv: float = MIN_IV, max_correlation: float = MAX_CORRELATION, **fitting: float
) -> tuple[WoeBins, Selection]:
    """Bins and the selection among them: after the cut points, one scan of ``train`` gives both.

    ``fitting`` goes to :func:`gradus.operators.woe.bins_of_counts`.
    """
    edges = coarse_edges(train, features, max_bins)
    joint = materialise(joint_bin_counts(train, edges, target))
    bins = bins_of_counts(counts_by_bin(joint, target), edges, **fitting)
    return bins, _selection(joint, bins, edges, min_iv, max_correlation)


def _selection(joint: DataFrame, bins: WoeBins, edges: dict[str, list[float]], min_iv: float, max_correlation: float) -> Selection:
    """IV floor, then degenerate features, then the correlation walk in IV order."""
    ivs = dict(sorted(((f, b.information_value) for f, b in bins.features.items()), key=lambda kv: (-kv[1], kv[0])))
    reasons = {f: BELOW_FLOOR for f, iv in ivs.items() if iv < min_iv}
    reasons.update({f: DEGENERATE for f in ivs if f not in reasons and len(bins.features[f].finite) < 2})
    ranking = [f for f in ivs if f not in reasons]
    pairs = correlations(joint, bin_values(bins.only(ranking), edges), ranking)
    selected, correlated = prune_correlated(pairs, ranking, max_correlation)
    return Selection(selected, {**reasons, **correlated}, ivs)
