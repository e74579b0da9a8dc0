"""Points table, per-applicant contributions and reason codes.

An applicant's contributions are an array built and sorted inside the row, so explaining a
whole book needs no shuffle and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradus.functions.columns import bin_index, literal, number, quoted, total
from gradus.operators.scoring import Scorecard, add_log_odds

# Wording shown to applicants.
FEATURE_DESCRIPTIONS = {
    "revolving_utilisation": "Proportion of available revolving credit already in use",
    "utilisation_x_delinquency": "Revolving credit usage, weighted by past missed payments",
    "age": "Age of the applicant",
    "debt_ratio": "Monthly debt repayments as a share of monthly income",
    "monthly_income": "Reported monthly income",
    "log_monthly_income": "Reported monthly income",
    "open_credit_lines": "Number of open credit lines and loans",
    "real_estate_lines": "Number of mortgage and property-secured lines",
    "real_estate_share_of_lines": "Share of credit lines that are property-secured",
    "unsecured_lines": "Number of unsecured credit lines",
    "dependents": "Number of financial dependants",
    "times_30_59_dpd": "Times 30-59 days late in the last two years",
    "times_60_89_dpd": "Times 60-89 days late in the last two years",
    "times_90_dpd": "Times 90+ days late in the last two years",
    "total_delinquencies": "Total missed payments in the last two years",
    "worst_delinquency_severity": "Severity of the worst missed payment on record",
    "delinquencies_per_credit_line": "Missed payments per open credit line",
    "monthly_debt_service": "Monthly debt repayment amount",
    "disposable_income": "Income left after debt repayments",
    "income_per_dependent": "Income available per household member",
    "flag_delinquency_sentinel": "Bureau delinquency record is coded rather than counted",
    "flag_monthly_income_missing": "No income figure was supplied",
    "flag_debt_ratio_is_amount": "Debt figure supplied without a matching income",
}
NOT_REPORTED = "not reported"


def describe(feature: str) -> str:
    return FEATURE_DESCRIPTIONS.get(feature, feature)


def points_table(spark: SparkSession, card: Scorecard) -> DataFrame:
    """Points of every bin: an equal share of the constant, less ``factor * beta * woe``."""
    n, s = max(len(card.features), 1), card.scaling
    terms = spark.createDataFrame(
        [(f, describe(f), b) for f, b in card.coefficients.items()], "feature string, description string, beta double"
    )
    shared = (s.offset - s.factor * card.intercept) / n
    by_feature = Window.partitionBy("feature")  # a feature has at most a dozen bins
    return (
        card.bins.only(card.features).table(spark)
        .join(F.broadcast(terms), "feature")
        .withColumn("points", F.round(F.lit(shared) - F.lit(s.factor) * F.col("beta") * F.col("woe"), 2))
        .withColumn("max_points_for_feature", F.max("points").over(by_feature))
        .select(
            "feature", "description", "bin_index", "bin", "count", "bad_rate", "woe", "points", "max_points_for_feature",
            F.round(F.col("max_points_for_feature") - F.col("points"), 2).alias("points_lost"),
        )
    )


def _entries(points: DataFrame) -> dict[str, list]:
    """The points table (features x bins rows) by feature."""
    out: dict[str, list] = {}
    for r in points.collect():
        out.setdefault(r["feature"], []).append(r)
    return out


def _slots(df: DataFrame, card: Scorecard, table: dict[str, list]) -> DataFrame:
    """Add ``_v_<f>`` (numeric value) and ``_s_<f>``: the position in ``table[f]`` of the bin the
    value falls in, NULL when no such bin was trained."""
    values = df.withColumns({f"_v_{f}": number(f) for f in table})
    placed = values.withColumns({f"_s_{f}": bin_index(f"_v_{f}", card.bins.features[f].edges) for f in table})

    def position(f: str) -> Column:
        steps = " ".join(f"WHEN {r['bin_index']} THEN {i}" for i, r in enumerate(table[f]))
        return F.expr(f"CASE {quoted(f'_s_{f}')} {steps} END")

    return placed.withColumns({f"_s_{f}": position(f) for f in table})


def _row_values(table: dict[str, list], f: str, column: str) -> Column:
    """Value of the chosen points-table row."""
    def text(v) -> str:
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return literal(v) if isinstance(v, float) else str(v)

    steps = " ".join(f"WHEN {i} THEN {text(r[column])}" for i, r in enumerate(table[f]))
    return F.expr(f"CASE {quoted(f'_s_{f}')} {steps} END")


def _contributions(df: DataFrame, card: Scorecard, points: DataFrame, id_col: str, min_lost: float | None, top_n: int | None) -> DataFrame:
    table = {f: rows for f, rows in _entries(points).items() if f in card.features}
    slots = _slots(df.select(*dict.fromkeys([id_col, *table])), card, table)

    def pick(f: str, column: str) -> Column:
        return _row_values(table, f, column)

    entries = []
    for f in table:
        lost = pick(f, "points_lost")
        entry = F.struct(
            (-lost).alias("order"), F.lit(f).alias("feature"), F.lit(describe(f)).alias("description"),
            F.col(f"_v_{f}").alias("value"), pick(f, "bin_index").alias("bin_index"), pick(f, "bin").alias("bin"),
            pick(f, "points").alias("points"), lost.alias("points_lost"), pick(f, "bad_rate").alias("bin_bad_rate"),
        )
        present = F.col(f"_s_{f}").isNotNull()
        entries.append(F.when(present & (lost > min_lost) if min_lost is not None else present, entry))
    ranked = F.sort_array(F.array_compact(F.array(*entries)))
    if top_n is not None:
        ranked = F.slice(ranked, 1, top_n)
    return slots.select(id_col, ranked.alias("ranked"))


def _one_per_row(contributions: DataFrame, id_col: str) -> DataFrame:
    # The outer form: for a plain explode the optimizer infers "array is not empty" and pushes
    # that test, with the whole array expression in it, below every projection.
    return contributions.select(id_col, F.posexplode_outer("ranked").alias("pos", "e")).where(F.col("e").isNotNull())


def explain(df: DataFrame, card: Scorecard, points: DataFrame, id_col: str = "applicant_id") -> DataFrame:
    """Every applicant's features ranked by points lost (ties by name)."""
    return (
        _one_per_row(_contributions(df, card, points, id_col, None, None), id_col)
        .select(id_col, (F.col("pos") + 1).alias("rank"), "e.feature", "e.description", "e.value", "e.bin_index", "e.bin", "e.points", "e.points_lost", "e.bin_bad_rate")
    )


def reason_codes(
    df: DataFrame, card: Scorecard, points: DataFrame, id_col: str = "applicant_id", top_n: int = 4, min_lost: float = 0.5
) -> DataFrame:
    """The largest material shortfalls of each applicant, one row per reason."""
    return (
        _one_per_row(_contributions(df, card, points, id_col, min_lost, top_n), id_col)
        .select(
            id_col, (F.col("pos") + 1).alias("rank"), "e.feature", F.col("e.description").alias("reason"),
            F.col("e.value").alias("applicant_value"), F.coalesce(F.col("e.value").cast("string"), F.lit(NOT_REPORTED)).alias("shown_value"),
            "e.bin", F.round("e.points_lost", 1).alias("points_lost"), F.round("e.bin_bad_rate", 4).alias("bin_default_rate"),
        )
    )


def reason_lists(df: DataFrame, card: Scorecard, points: DataFrame, id_col: str = "applicant_id", top_n: int = 4, min_lost: float = 0.5) -> DataFrame:
    """Reason codes as one array per applicant (empty when nothing was lost)."""
    short = _contributions(df, card, points, id_col, min_lost, top_n)
    return short.select(id_col, F.transform("ranked", lambda e: e["feature"]).alias("reasons"))


def global_importance(points: DataFrame) -> DataFrame:
    """How far each feature can move a score, and how far it does over the book."""
    mean = points.groupBy("feature").agg(
        (F.sum(F.col("points") * F.col("count")) / F.sum("count")).alias("_mean"), F.sum("count").alias("_rows")
    ).where(F.col("_rows") > 0)
    return (
        points.join(mean, "feature")
        .groupBy("feature", "description")
        .agg(
            F.min("points").alias("min"), F.max("points").alias("max"),
            F.round(F.max("points") - F.min("points"), 2).alias("points_range"),
            F.round(F.sum(F.col("count") * F.abs(F.col("points") - F.col("_mean"))) / F.sum("count"), 2).alias("population_weighted_spread"),
            F.round(F.max("count") / F.sum("count"), 3).alias("largest_bin_share"),
        )
        .orderBy(F.desc("population_weighted_spread"), "feature")
    )


def summed_points(df: DataFrame, card: Scorecard, points: DataFrame, out: str = "points_total") -> DataFrame:
    """Score rebuilt as the sum of one points-table row per feature; an untrained Missing bin
    is neutral, worth the shared constant."""
    s = card.scaling
    shared = (s.offset - s.factor * card.intercept) / max(len(card.features), 1)
    table = {f: rows for f, rows in _entries(points).items() if f in card.features}
    parts = [F.coalesce(_row_values(table, f, "points"), F.lit(shared)) for f in card.features]
    return _slots(df, card, table).withColumn(out, total(parts)).select(*df.columns, out)


def reconstruct(df: DataFrame, card: Scorecard, points: DataFrame) -> DataFrame:
    """Audit: the largest gap between the rebuilt and the shipped score."""
    s = card.scaling
    both = add_log_odds(summed_points(df, card, points), card, "_logit")
    gap = F.abs(F.col("points_total") - (F.lit(s.offset) - F.lit(s.factor) * F.col("_logit")))
    return both.agg(F.count(F.lit(1)).alias("applicants"), F.max(gap).alias("max_abs_difference"))


def monotone_score_audit(
    df: DataFrame, card: Scorecard, column: str, grid: list[float], id_col: str = "applicant_id", derive=lambda d: d
) -> DataFrame:
    """Steps of ``column`` along ``grid`` that raise the score of some applicant.

    Both ends of a step are scored in the same row; ``derive`` rebuilds dependent features.
    """
    steps = F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in zip(grid, grid[1:])])
    exploded = df.withColumn("_step", F.explode(steps))
    low = add_log_odds(derive(exploded.withColumn(column, F.col("_step.a"))), card, "_low")
    high = add_log_odds(derive(low.withColumn(column, F.col("_step.b"))), card, "_high")
    return (
        high.groupBy(F.col("_step.a").alias("from_value"), F.col("_step.b").alias("to_value"))
        .agg(F.count(F.lit(1)).alias("applicants"), F.count_if(F.col("_high") < F.col("_low") - F.lit(1e-9)).alias("score_rises"))
    )
