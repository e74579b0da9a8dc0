"""Ranking, calibration and profit tables.

Every metric starts from one row per distinct score (``score_table``), which collapses a
scorecard's output to a small table before anything is ordered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradus.functions.columns import DEFAULT_BANDS, all_of, with_row
from gradus.operators.ordering import quantiles, running_totals, score_table, totals_at_ranks
from gradus.sources.tables import materialise

EPSILON = 2.220446049250313e-16


def _ranked_scores(df: DataFrame, p: str, y: str, by: list[str]) -> DataFrame:
    table = materialise(score_table(df, p, y, by).withColumn("goods", F.col("n") - F.col("bads")))
    return running_totals(table, "p", ["goods", "bads"], by=by)


def _auc() -> Column:
    pairs = F.sum(F.col("bads").cast("double") * (F.col("cum_goods") - F.col("goods") + F.col("goods") / F.lit(2.0)))
    return F.try_divide(pairs, F.sum("bads").cast("double") * F.sum("goods").cast("double"))


def auc_gini(df: DataFrame, p: str, y: str, by: list[str] | None = None) -> DataFrame:
    """AUC with ties counted half, and Gini; NULL when only one class is present."""
    by = by or []
    return _ranked_scores(df, p, y, by).groupBy(*by).agg(_auc().alias("auc")).withColumn("gini", F.lit(2.0) * F.col("auc") - F.lit(1.0))


def ks(df: DataFrame, p: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Largest gap of the two cumulative distributions, read at the ends of tied scores."""
    by = by or []
    return _with_ks(_ranked_scores(df, p, y, by), by).groupBy(*by).agg(F.coalesce(F.max("_gap"), F.lit(0.0)).alias("ks"))


def _with_ks(ranked: DataFrame, by: list[str]) -> DataFrame:
    # Totals by aggregate, not by an unordered window: no group has to sit in one task.
    sums = ranked.groupBy(*[F.col(b).alias(f"_by_{b}") for b in by]).agg(F.sum("goods").alias("_g"), F.sum("bads").alias("_b"))
    if by:
        joined = ranked.join(sums, all_of([F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]))
    else:
        joined = with_row(ranked, sums)
    gap = F.abs(F.try_divide(F.col("cum_bads").cast("double"), F.col("_b").cast("double"))
                - F.try_divide(F.col("cum_goods").cast("double"), F.col("_g").cast("double")))
    return joined.withColumn("_gap", gap)


def evaluate(df: DataFrame, p: str, y: str, by: list[str] | None = None) -> DataFrame:
    """The eight headline metrics, from the score table alone."""
    by = by or []
    ranked = _with_ks(_ranked_scores(df, p, y, by), by)
    n = F.sum("n").cast("double")
    clipped = F.least(F.greatest(F.col("p"), F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    return ranked.groupBy(*by).agg(
        _auc().alias("auc"),
        (F.lit(2.0) * _auc() - F.lit(1.0)).alias("gini"),
        F.coalesce(F.max("_gap"), F.lit(0.0)).alias("ks"),
        (F.sum(F.col("bads") * (F.lit(1.0) - F.col("p")) * (F.lit(1.0) - F.col("p")) + F.col("goods") * F.col("p") * F.col("p")) / n).alias("brier"),
        (-F.sum(F.col("bads") * F.ln(clipped) + F.col("goods") * F.ln(F.lit(1.0) - clipped)) / n).alias("log_loss"),
        (F.sum("bads").cast("double") / n).alias("observed_default_rate"),
        (F.sum(F.col("p") * F.col("n")) / n).alias("mean_predicted_rate"),
        F.sum("n").alias("n"),
    )


# --- tables by rank -----------------------------------------------------------------------
def calibration_table(df: DataFrame, p: str, y: str, id_col: str, bins: int = 10, **kw) -> DataFrame:
    """Predicted against observed rate by predicted decile (quantile cut of the first-rank)."""

    def ends(n: int) -> list[int]:
        return [n if d == bins else min(n, 1 + (d * (n - 1)) // bins) for d in range(1, bins + 1)]

    n, _, cuts = totals_at_ranks(df, p, y, id_col, ends, **kw)
    rows, last, bads, sum_p = [], 0, 0, 0.0
    for decile, rank in enumerate(ends(n), 1):
        if n == 0 or rank <= last:
            continue
        cut, count = cuts[rank], rank - last
        predicted, observed = (cut.sum_p - sum_p) / count, (cut.bads - bads) / count
        rows.append((decile, count, predicted, observed, predicted - observed))
        last, bads, sum_p = rank, cut.bads, cut.sum_p
    return df.sparkSession.createDataFrame(
        rows, "decile int, count long, predicted_rate double, observed_rate double, difference double"
    )


def gains_table(df: DataFrame, p: str, y: str, id_col: str, bins: int = 10, **kw) -> DataFrame:
    """Cumulative capture of bads, riskiest decile first."""

    def ends(n: int) -> list[int]:
        return [-(-d * n // bins) for d in range(1, bins + 1)]

    n, total_bads, cuts = totals_at_ranks(df, p, y, id_col, ends, descending=True, **kw)
    rows, last, bads = [], 0, 0
    for decile, rank in enumerate(ends(n), 1):
        if n == 0 or rank <= last:
            continue
        cut, count = cuts[rank], rank - last
        capture = cut.bads / total_bads if total_bads else None
        rows.append((decile, count, cut.bads - bads, (cut.bads - bads) / count, cut.bads, capture, rank / n, capture / (rank / n) if total_bads else None))
        last, bads = rank, cut.bads
    return df.sparkSession.createDataFrame(
        rows,
        "decile int, count long, bads long, bad_rate double, cumulative_bads long, cumulative_bad_capture double, "
        "cumulative_population double, lift double",
    )


def approval_curve(
    df: DataFrame, p: str, y: str, id_col: str, revenue_per_good: float = 450.0, loss_per_bad: float = 2800.0, steps: int = 100, **kw
) -> DataFrame:
    """Book economics when the safest share of applicants is accepted, for each share."""

    def accepted(n: int) -> list[int]:
        return [max(1, round(step / steps * n)) for step in range(1, steps + 1)]

    n, _, cuts = totals_at_ranks(df, p, y, id_col, accepted, **kw)
    rows = []
    for step, rank in enumerate(accepted(n), 1) if n else []:
        cut = cuts[rank]
        rows.append((
            step, rank / n, rank, cut.bads / rank, (rank - cut.bads) * revenue_per_good - cut.bads * loss_per_bad, cut.p,
        ))
    return df.sparkSession.createDataFrame(
        rows, "step int, approval_rate double, accepted long, bad_rate double, expected_profit double, score_cutoff_probability double"
    )


def best_cutoff(curve: DataFrame) -> DataFrame:
    """First step of highest profit (one row)."""
    return curve.orderBy(F.desc("expected_profit"), "step").limit(1)


@dataclass(frozen=True)
class Economics:
    revenue_per_good: float = 450.0
    loss_per_bad: float = 2800.0


def apply_cutoff(
    df: DataFrame, p: str, y: str, cutoff: DataFrame | float, raw_score: str | None = None, economics: Economics = Economics()
) -> DataFrame:
    """Business result of a frozen cut-off on another sample, in one aggregate.

    ``cutoff`` is a probability or a one-row ``best_cutoff`` table.
    """
    if isinstance(cutoff, DataFrame):
        frozen = cutoff.select(F.col("score_cutoff_probability").alias("pd_cutoff"), F.col("approval_rate").alias("approval_rate_on_validation"))
        marked = with_row(df, frozen)
    else:
        marked = df.withColumns({"pd_cutoff": F.lit(float(cutoff)), "approval_rate_on_validation": F.lit(None).cast("double")})
    taken, bad = F.col(p) <= F.col("pd_cutoff"), F.col(y).cast("bigint")
    cut_score = F.min(F.when(taken, F.col(raw_score))) if raw_score else F.lit(None).cast("double")
    sums = marked.agg(
        F.first("pd_cutoff").alias("pd_cutoff"), cut_score.alias("score_cutoff"),
        F.first("approval_rate_on_validation").alias("approval_rate_on_validation"),
        F.count(F.lit(1)).alias("n"), F.sum(bad).alias("all_bads"),
        F.count_if(taken).alias("accepted"), F.coalesce(F.sum(F.when(taken, bad)), F.lit(0)).alias("bads"),
    )

    def profit(rows: Column, bads: Column) -> Column:
        return (rows - bads) * F.lit(economics.revenue_per_good) - bads * F.lit(economics.loss_per_bad)

    chosen, everyone = profit(F.col("accepted"), F.col("bads")), profit(F.col("n"), F.col("all_bads"))
    return sums.select(
        "pd_cutoff", "score_cutoff", "approval_rate_on_validation",
        (F.col("accepted").cast("double") / F.col("n").cast("double")).alias("approval_rate_on_test"),
        (F.col("bads").cast("double") / F.greatest(F.col("accepted"), F.lit(1)).cast("double")).alias("bad_rate_at_cutoff"),
        chosen.alias("expected_profit_at_cutoff"), everyone.alias("expected_profit_approve_all"),
        (chosen - everyone).alias("profit_uplift"),
    )


# --- bands and segments -------------------------------------------------------------------
def band_table(decisions: DataFrame, y: str, bands=DEFAULT_BANDS) -> DataFrame:
    """Share and realised default rate of each grade, lowest grade first; empty grades drop out."""
    ordered = sorted(bands, key=lambda b: float(b[1]))
    names = decisions.sparkSession.createDataFrame(
        [(i, n, label) for i, (n, _, label) in enumerate(ordered)], "position int, band string, label string"
    )
    grouped = decisions.groupBy("band").agg(
        F.count(F.lit(1)).alias("applicants"), F.sum(F.col(y).cast("bigint")).alias("bads"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"),
    )
    # A row per grade from here on, so whole-table windows are tiny.
    everyone = Window.partitionBy(F.lit(0))
    return (
        grouped.join(F.broadcast(names), "band")
        .select(
            "position", "band", "label", "min_score", "max_score", "applicants",
            (F.col("applicants").cast("double") / F.sum("applicants").over(everyone).cast("double")).alias("population_share"),
            (F.col("bads").cast("double") / F.col("applicants").cast("double")).alias("observed_default_rate"),
        )
        .orderBy("position")
    )


def bands_monotonic(table: DataFrame) -> DataFrame:
    """Whether the default rate never rises from the lowest grade to the highest."""
    previous = F.lag("observed_default_rate").over(Window.partitionBy(F.lit(0)).orderBy("position"))
    steps = table.select(F.coalesce(F.col("observed_default_rate") <= previous, F.lit(True)).alias("ok"))
    return steps.agg(F.bool_and("ok").alias("bands_monotonic"))


def segment_report(df: DataFrame, p: str, y: str, segment: str, min_rows: int = 200) -> DataFrame:
    """Gini and calibration per segment; small or one-class segments are left out."""
    return (
        evaluate(df, p, y, by=[segment])
        .where((F.col("n") >= min_rows) & F.col("auc").isNotNull())
        .select(segment, "n", "gini", "observed_default_rate", "mean_predicted_rate")
    )


def dataset_summary(gold: DataFrame, target: str, features: list[str]) -> DataFrame:
    """Rows, features, default rate and split sizes as ``metric, value`` rows."""
    splits = gold.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("bads"))
    available = len([f for f in features if f in gold.columns])
    one = splits.agg(
        F.sum("n").alias("n"), F.sum("bads").alias("bads"),
        *[F.coalesce(F.sum(F.when(F.col("split") == s, F.col("n"))), F.lit(0)).alias(s) for s in ("train", "valid", "test")],
    )
    return one.select(F.expr(
        "stack(6, 'rows', cast(n as double), 'features_available', cast(" + str(available) + " as double), "
        "'default_rate', cast(bads as double) / cast(n as double), 'split_train', cast(train as double), "
        "'split_valid', cast(valid as double), 'split_test', cast(test as double)) as (metric, value)"
    ))


def score_histogram(df: DataFrame, score: str, y: str, bins: int = 29, tails: tuple[float, float] = (0.005, 0.995)) -> DataFrame:
    """Density of the score per outcome, between two tail percentiles; the last bin is closed.

    Without a score there are no bins and no rows.
    """
    cell = quantiles(df, [score], list(tails)).get((None, score))
    low, high = (cell.values[t] for t in tails) if cell is not None and cell.n else (0.0, 0.0)
    width = (high - low) / bins
    s = F.col(score)
    index = F.least(F.floor((s - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int") if width > 0 else F.lit(0)
    counted = (
        df.where(s.between(low, high)).select(F.col(y).cast("int").alias("outcome"), index.alias("bin"))
        .groupBy("outcome", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    # two classes x 29 bins
    rows_in_class = F.sum("n").over(Window.partitionBy("outcome"))
    return counted.select(
        "outcome", "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"), "n",
        (F.col("n").cast("double") / (rows_in_class.cast("double") * F.lit(width if width > 0 else 1.0))).alias("density"),
    )
