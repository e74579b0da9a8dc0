"""Population stability, drift reports, stress shifts and gates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradus.functions.columns import id_uniform, left_closed_index, literal, number, psi_verdict, quoted, with_row
from gradus.operators.ordering import melt, quantiles
from gradus.sources.tables import materialise

FLOOR = 1e-4

# What to do about each verdict on the score.
ACTIONS = {
    "stable": "No action. Score distribution is consistent with development.",
    "investigate": "Investigate. Check the largest feature shifts and recent acquisition channels before the next review.",
    "revalidate": "Revalidate. The scored population no longer resembles the development sample; refit before further lending.",
}


@dataclass(frozen=True)
class StabilityBins:
    """How one column is binned: inner cut points, or the most common values."""

    column: str
    cuts: list[float]
    discrete: bool

    @property
    def size(self) -> int:
        return len(self.cuts) + 1

    def index(self) -> Column:
        if not self.discrete:
            return left_closed_index(self.column, self.cuts)
        c = quoted(self.column)
        steps = " ".join(f"WHEN {c} = {literal(v)} THEN {i}" for i, v in enumerate(self.cuts))
        return F.expr(f"CASE WHEN {c} IS NULL THEN NULL {steps} ELSE {len(self.cuts)} END")


def common_levels(df: DataFrame, columns: list[str], max_levels: int = 20) -> dict[str, list[float]]:
    """Most common values per column (ties: smaller value first).

    Values are counted before they are ranked, and Spark keeps only the top rows of each map
    task's share before the ranking shuffle.
    """
    numbers = df.select(*[number(c).alias(c) for c in columns])
    counted = melt(numbers, [], {c: [F.col(c)] for c in columns}, ["v"]).where(F.col("v").isNotNull()).groupBy("feature", "v").agg(
        F.count(F.lit(1)).alias("n")
    )
    w = Window.partitionBy("feature").orderBy(F.desc("n"), "v")
    top = counted.withColumn("r", F.row_number().over(w)).where(F.col("r") <= max_levels)
    out: dict[str, list[float]] = {c: [] for c in columns}
    for r in sorted(top.collect(), key=lambda r: r["r"]):
        out[r["feature"]].append(r["v"])
    return out


def stability_bins(reference: DataFrame, columns: list[str], bins: int = 10, max_levels: int = 20) -> dict[str, StabilityBins]:
    """Bins from the reference: its deciles, or its common values when those collapse."""
    probs = [i / bins for i in range(bins + 1)]
    found = quantiles(reference, columns, probs)
    out, collapsed = {}, []
    for c in columns:
        cell = found.get((None, c))
        edges = sorted({cell.values[p] for p in probs}) if cell and cell.n else []
        if len(edges) < 3:
            collapsed.append(c)
        else:
            out[c] = StabilityBins(c, edges[1:-1], False)
    if collapsed:
        for c, levels in common_levels(reference, collapsed, max_levels).items():
            out[c] = StabilityBins(c, levels, True)
    return {c: out[c] for c in columns}


def _counts(df: DataFrame, spec: dict[str, StabilityBins], side: str) -> DataFrame:
    numbers = df.select(*[number(c).alias(c) for c in spec])
    cells = {c: [s.index()] for c, s in spec.items()}
    return (
        melt(numbers, [], cells, ["bin"]).where(F.col("bin").isNotNull())
        .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))
    )


def stability_index(reference: DataFrame, current: DataFrame, spec: dict[str, StabilityBins], min_rows: int = 0) -> DataFrame:
    """PSI per column for given bins.  Empty bins get the floor; shares are not rescaled."""
    spark = reference.sparkSession
    both = _counts(reference, spec, "r").unionByName(_counts(current, spec, "c"))
    wide = both.groupBy("feature", "bin").agg(
        F.coalesce(F.sum(F.when(F.col("side") == "r", F.col("n"))), F.lit(0)).alias("r"),
        F.coalesce(F.sum(F.when(F.col("side") == "c", F.col("n"))), F.lit(0)).alias("c"),
    )
    all_bins = spark.createDataFrame([(c, i) for c, s in spec.items() for i in range(s.size)], "feature string, bin int")
    w = Window.partitionBy("feature")  # a column has some 20 bins
    full = all_bins.join(wide, ["feature", "bin"], "left").select(
        "feature", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("c", F.lit(0)).alias("c")
    ).withColumns({"nr": F.sum("r").over(w), "nc": F.sum("c").over(w)})
    e = F.greatest(F.coalesce(F.try_divide(F.col("r").cast("double"), F.col("nr").cast("double")), F.lit(0.0)), F.lit(FLOOR))
    a = F.greatest(F.coalesce(F.try_divide(F.col("c").cast("double"), F.col("nc").cast("double")), F.lit(0.0)), F.lit(FLOOR))
    return (
        full.groupBy("feature", F.col("nr").alias("reference_rows"), F.col("nc").alias("current_rows"))
        .agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))
        .where((F.col("reference_rows") >= min_rows) & (F.col("current_rows") >= min_rows))
    )


def psi(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, max_levels: int = 20, min_rows: int = 0) -> DataFrame:
    """Population Stability Index of many columns: ``feature, reference_rows, current_rows, psi``."""
    return stability_index(reference, current, stability_bins(reference, columns, bins, max_levels), min_rows)


def discrete_psi(reference: DataFrame, current: DataFrame, columns: list[str], max_levels: int = 20) -> DataFrame:
    spec = {c: StabilityBins(c, v, True) for c, v in common_levels(reference, columns, max_levels).items()}
    return stability_index(reference, current, spec)


def with_verdict(table: DataFrame, stable: float = 0.10, investigate: float = 0.25) -> DataFrame:
    return table.withColumn("verdict", psi_verdict(F.col("psi"), stable, investigate))


SHIFTS_SCHEMA = "array<struct<shift_rank: int, feature: string, psi: double, verdict: string>>"


@dataclass(frozen=True)
class DriftReport:
    """``shifts``: PSI, verdict and rank per feature.  ``summary``: one row on the score."""

    shifts: DataFrame
    summary: DataFrame

    def record(self) -> DataFrame:
        """One monitoring row with the largest shifts as JSON."""
        top = self.shifts.where(F.col("shift_rank") <= 5)
        listed = top.agg(F.array_sort(F.collect_list(F.struct("shift_rank", "feature", "psi", "verdict"))).alias("s"))
        return with_row(self.summary, listed).select(
            "score_psi", "score_verdict", "reference_mean_score", "current_mean_score", F.to_json("s").alias("largest_shifts"), "action"
        )


def drift_report(
    reference: DataFrame, current: DataFrame, features: list[str], score: str, bins: int = 10, stable: float = 0.10, investigate: float = 0.25,
    spec: dict[str, StabilityBins] | None = None,
) -> DriftReport:
    """PSI of the score and of every feature, from one set of bins and one pass per side.

    ``spec`` are bins of the reference that are known already.
    """
    spec = stability_bins(reference, [score, *features], bins) if spec is None else spec
    table = materialise(with_verdict(stability_index(reference, current, spec), stable, investigate))
    enough = (F.col("feature") != score) & (F.col("reference_rows") >= bins) & (F.col("current_rows") >= bins)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("psi"), "feature"))  # a row per feature
    shifts = table.where(enough).select("feature", "psi", "verdict").withColumn("shift_rank", rank)
    means = with_row(reference.agg(F.avg(score).alias("reference_mean_score")), current.agg(F.avg(score).alias("current_mean_score")))
    action = F.lit(ACTIONS["revalidate"])
    for verdict in ("investigate", "stable"):
        action = F.when(F.col("verdict") == verdict, F.lit(ACTIONS[verdict])).otherwise(action)
    summary = with_row(table.where(F.col("feature") == score), means).select(
        F.col("psi").alias("score_psi"), F.col("verdict").alias("score_verdict"), "reference_mean_score", "current_mean_score", action.alias("action")
    )
    return DriftReport(shifts, summary)


def stop_the_line(report: DriftReport) -> None:
    """Fail the job when the score population must be revalidated."""
    row = report.summary.first()
    if row["score_verdict"] == "revalidate":
        raise RuntimeError(f"score PSI {row['score_psi']:.4f}: {row['action']}")


def stress_shift(df: DataFrame, id_col: str, seed: int = 42, intensity: float = 1.0) -> DataFrame:
    """A younger, more stretched population on thinner incomes.  The draw depends on the row's
    id only, so it is the same at any partition count and in any re-run."""
    i = float(intensity)
    changes: dict[str, Column] = {}
    if "age" in df.columns:
        younger = F.col("age") - F.lit(8.0 * i) * (F.lit(0.5) + id_uniform(F.col(id_col), seed))
        changes["age"] = F.when(F.col("age").isNotNull(), F.least(F.greatest(younger, F.lit(18.0)), F.lit(100.0)))
    # Relative change of each column at intensity 1.
    for column, change in {
        "revolving_utilisation": 0.45,
        "utilisation_x_delinquency": 0.45,
        "debt_ratio": 0.30,
        "monthly_income": -0.20,
        "log_monthly_income": -0.05,
        "disposable_income": -0.25,
        "income_per_dependent": -0.20,
    }.items():
        if column in df.columns:
            changes[column] = F.col(column) * F.lit(1.0 + change * i)
    return df.withColumns(changes)


def promotion_gate(
    metrics: DataFrame, monotonic: DataFrame, stability: DataFrame, min_gini: float = 0.65, min_ks: float = 0.50, max_brier: float = 0.06
) -> DataFrame:
    """``gate, value, threshold, passed`` rows from three one-row tables: test metrics,
    ``bands_monotonic`` and the score's ``verdict``."""
    one = with_row(with_row(metrics.select("gini", "ks", "brier"), monotonic), stability.select("psi", "verdict"))
    return one.select(F.expr(
        f"stack(5, 'gini', gini, {min_gini}D, gini >= {min_gini}D, 'ks', ks, {min_ks}D, ks >= {min_ks}D, "
        f"'brier', brier, {max_brier}D, brier <= {max_brier}D, "
        "'bands_monotonic', cast(cast(bands_monotonic as int) as double), 1D, bands_monotonic, "
        "'population_stable', psi, cast(null as double), verdict = 'stable') as (gate, value, threshold, passed)"
    ))


def promoted(gate: DataFrame) -> DataFrame:
    return gate.agg(F.bool_and("passed").alias("promoted"))
