"""Model fits, calibration, scoring, explanation."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.ctes import bin_label, bins_over, md5u, with_
from catalogue.fixed import BANDS, BETAS, CURVE, FIXED_EDGES, INTERCEPT, SEED
from catalogue.inputs import fixed_card, r6, splits
from gradus.functions.columns import ScoreScaling, assign_band
from gradus.operators import explain as ex
from gradus.operators import fitting as fit
from gradus.operators import scoring as sc
from gradus.operators.evaluation import evaluate
from gradus.operators.features import MODEL_FEATURES, TARGET
from gradus.operators.selection import fit_and_select
from gradus.operators.woe import woe_fit
from gradus.plans.development import candidate_metrics
from gradus.sources.retail import scored
from gradus.sources import models
from gradus.sources.tables import materialise, staging_dir

FEATURES = list(FIXED_EDGES)
SCALE = ScoreScaling()


def _fixed(spark, sf):
    train, valid, test = splits(spark, sf)
    return fixed_card(train), train, valid, test


# --- fits ---------------------------------------------------------------------------------
def _selected(spark, sf):
    """Train, valid and test, staged, and the bins of the model features that selection keeps."""
    train, valid, test = (materialise(s) for s in splits(spark, sf))
    bins, selection = fit_and_select(train, MODEL_FEATURES, TARGET)
    return train, valid, test, bins.only(selection.selected)


def e01_logistic(spark, sf):
    train, _, _, bins = _selected(spark, sf)
    card = fit.fit_champion(train, bins, TARGET)
    rows = [("intercept", card.intercept), *card.coefficients.items()]
    return spark.createDataFrame(rows, "feature string, beta double")


def e02_boosted(spark, sf):
    train, valid, test, bins = _selected(spark, sf)
    challenger = fit.fit_challenger(train, valid, list(bins.features), TARGET)
    return evaluate(challenger.score(test), "probability_of_default", TARGET)


def _raw_scored(spark, sf):
    card, _, valid, _ = _fixed(spark, sf)
    return sc.add_log_odds(valid, card, "_l").select(sc.sigmoid(F.col("_l")).alias("p"), F.col(TARGET).alias("y"))


def e03_isotonic(spark, sf):
    rows = scored(spark, sf)
    curve = fit.fit_calibrator(rows, "p", "y", "isotonic")
    return curve.add(rows.select("p").distinct(), "p", "calibrated").withColumns(r6("calibrated"))


def e04_platt(spark, sf):
    curve = fit.fit_calibrator(_raw_scored(spark, sf), "p", "y", "platt")
    return spark.createDataFrame([(curve.slope, curve.intercept)], "slope double, intercept double")


def e05_calibrated_pd(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    return sc.score(test, card).select("applicant_id", F.round("probability_of_default", 6).alias("probability_of_default"))


def e06_raw_score(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    return sc.score(test, card).select("applicant_id", F.round("raw_score", 6).alias("raw_score"))


def e07_score_scaling(spark, sf):
    return scored(spark, sf).select("id", F.round(SCALE.to_score(F.col("p")), 6).alias("score"))


def e08_score_to_probability(spark, sf):
    return scored(spark, sf).select("id", F.round(SCALE.to_probability(SCALE.to_score(F.col("p"))), 6).alias("p"))


def e09_bands(spark, sf):
    return scored(spark, sf).select("id", assign_band(SCALE.to_score(F.col("p"))).alias("band"))


def e10_decision_fixed_model(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    return sc.decide(test, card).withColumns(r6("probability_of_default"))


def e11_band_counts(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    return sc.band_counts(sc.decide(test, card))


def e12_decision_struct(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    return sc.decision_struct(test, card).select("applicant_id", F.round("decision.probability_of_default", 6).alias("probability_of_default"), "decision.score", "decision.band")


def e13_candidates(spark, sf):
    train, valid, test, bins = _selected(spark, sf)
    card = fit.fit_champion(train, bins, TARGET)
    challenger = fit.fit_challenger(train, valid, list(bins.features), TARGET)
    return candidate_metrics({"logistic_woe": lambda d: sc.score(d, card), "boosted": challenger.score}, train.unionByName(valid).unionByName(test))


def e14_published_scorecard(spark, sf):
    """Published, read back by name and used: the same decisions as before it was saved."""
    card, _, _, test = _fixed(spark, sf)
    root = f"{staging_dir(spark)}/models-{uuid.uuid4().hex}"
    models.publish(spark, root, "1", replace(card, intercept=0.0))
    models.publish(spark, root, "2", card)
    return sc.decide(test, models.read_model(spark, root, "scorecard")).withColumns(r6("probability_of_default"))


# --- explanation --------------------------------------------------------------------------
def g01_points_fixed_model(spark, sf):
    card = _fixed(spark, sf)[0]
    return ex.points_table(spark, card).withColumns(r6("bad_rate", "woe"))


def g03_contributions(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    points = materialise(ex.points_table(spark, card))
    return ex.explain(test, card, points).withColumns(r6("bin_bad_rate"))


def g04_reason_codes(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    return ex.reason_codes(test, card, materialise(ex.points_table(spark, card)))


def g05_importance(spark, sf):
    return ex.global_importance(ex.points_table(spark, _fixed(spark, sf)[0]))


def g07_reconstruct(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    audit = ex.reconstruct(test, card, materialise(ex.points_table(spark, card)))
    return audit.select("applicants", (F.col("max_abs_difference") < 0.1).alias("within_a_tenth"))


def g08_permutation_importance(spark, sf):
    card, train, _, test = _fixed(spark, sf)

    def raw(df: DataFrame, out: str) -> DataFrame:
        return sc.add_log_odds(df, card, out)

    out = fit.permutation_importance(test, FEATURES, TARGET, "applicant_id", raw, seed=SEED)
    return out.withColumns(r6("permuted_auc", "auc_loss"))


def g08_challenger_importance(spark, sf):
    train, valid, test, bins = _selected(spark, sf)
    challenger = fit.fit_challenger(train, valid, list(bins.features), TARGET)
    return fit.permutation_importance(test, challenger.features, TARGET, "applicant_id", challenger.raw_probability, seed=SEED)


def g09_shown_values(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    shown = ex.reason_codes(test, card, materialise(ex.points_table(spark, card)))
    return shown.groupBy("feature").agg(F.count_if(F.col("shown_value") == ex.NOT_REPORTED).alias("not_reported"), F.count(F.lit(1)).alias("reasons"))


def h11_monotone_score(spark, sf):
    card, _, _, test = _fixed(spark, sf)
    monotone = woe_fit(splits(spark, sf)[0], ["times_90_dpd", "revolving_utilisation"], TARGET)
    grids = {"times_90_dpd": [0.0, 1.0, 2.0, 4.0], "revolving_utilisation": [0.0, 0.03, 0.06, 0.5, 1.5]}
    rules = sc.Scorecard(monotone, {"times_90_dpd": -0.75, "revolving_utilisation": -0.9}, -1.6, bands=BANDS)
    audits = [ex.monotone_score_audit(test, rules, c, g).withColumn("feature", F.lit(c)) for c, g in grids.items()]
    return reduce(DataFrame.unionByName, audits)


GRIDS = {"times_90_dpd": [0.0, 1.0, 2.0, 4.0], "revolving_utilisation": [0.0, 0.03, 0.045, 0.055, 0.5, 1.5]}


def h11_monotone_score_fixed_model(spark, sf):
    """The coarse bins are not merged, so the audit has rises to find."""
    card, _, _, test = _fixed(spark, sf)
    audits = [ex.monotone_score_audit(test, card, c, g).withColumn("feature", F.lit(c)) for c, g in GRIDS.items()]
    return reduce(DataFrame.unionByName, audits)


QUERIES = {f.__name__: f for f in (
    h11_monotone_score_fixed_model, e01_logistic, e02_boosted, e03_isotonic, e04_platt, e05_calibrated_pd, e06_raw_score, e07_score_scaling, e08_score_to_probability, e09_bands,
    e10_decision_fixed_model, e11_band_counts, e12_decision_struct, e13_candidates, e14_published_scorecard, g01_points_fixed_model, g03_contributions, g04_reason_codes,
    g05_importance, g07_reconstruct, g08_permutation_importance, g08_challenger_importance, g09_shown_values, h11_monotone_score,
)}

# --- SQL ----------------------------------------------------------------------------------
FACTOR, OFFSET = f"cast({SCALE.factor!r} AS double)", f"cast({SCALE.offset!r} AS double)"


def score_sql(p: str) -> str:
    clipped = f"least(greatest({p}, 1e-6::double), 1 - 1e-6::double)"
    return f"({OFFSET} + {FACTOR} * ln((1 - {clipped}) / {clipped}))"


def band_sql(score: str, bands) -> str:
    ordered = sorted(bands, key=lambda b: -b[1])
    return "CASE " + " ".join(f"WHEN {score} >= {m} THEN '{n}'" for n, m, _ in ordered) + f" ELSE '{ordered[-1][0]}' END"


def curve_sql(x: str) -> str:
    b, y = CURVE.boundaries, CURVE.predictions
    parts = [f"WHEN {x} < {b[0]}::double THEN {y[0]}::double"]
    for i in range(len(b) - 1):
        parts.append(f"WHEN {x} < {b[i + 1]}::double THEN {y[i]}::double + ({y[i + 1]}::double - {y[i]}::double) * ({x} - {b[i]}::double) / ({b[i + 1]}::double - {b[i]}::double)")
    return "CASE " + " ".join(parts) + f" ELSE {y[-1]}::double END"


MODEL = {
    **bins_over("fixed_edges"),
    "betas": "SELECT * FROM (VALUES " + ", ".join(f"('{f}', {b}::double)" for f, b in BETAS.items()) + ") AS t(feature, beta)",
    "points0": f"""SELECT feature, bin_index, count, bad_rate, woe,
        round(({OFFSET} - {FACTOR} * {INTERCEPT}::double) / {len(BETAS)} - {FACTOR} * beta * woe, 2) AS points FROM woe JOIN betas USING (feature)""",
    "points": """SELECT *, max(points) OVER (PARTITION BY feature) AS max_points_for_feature,
        round(max(points) OVER (PARTITION BY feature) - points, 2) AS points_lost FROM points0""",
    "test_long": "SELECT applicant_id, y, feature, value FROM (SELECT applicant_id, target_default_90dpd_2yr AS y, "
    + ", ".join(f"cast({f} AS double) AS {f}" for f in FEATURES) + " FROM gold WHERE split = 'test') UNPIVOT INCLUDE NULLS (value FOR feature IN ("
    + ", ".join(FEATURES) + "))",
    "test_bins": """SELECT applicant_id, y, l.feature, value, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e < value)) END AS bin_index
        FROM test_long l JOIN fixed_edges USING (feature)""",
    # A missing value that training never saw is neutral.
    "logits": f"""SELECT applicant_id, max(y) AS y, {INTERCEPT}::double + sum(beta * coalesce(woe, 0)) AS logit
        FROM test_bins JOIN betas USING (feature) LEFT JOIN woe USING (feature, bin_index) GROUP BY 1""",
    "decided": f"""SELECT applicant_id, y, least(greatest({curve_sql('raw')}, 1e-6::double), 1 - 1e-6::double) AS pd, raw_score,
        cast(round_even(raw_score, 0) AS bigint) AS score, {band_sql('raw_score', BANDS)} AS band
        FROM (SELECT applicant_id, y, 1 / (1 + exp(-logit)) AS raw, {OFFSET} - {FACTOR} * logit AS raw_score FROM logits)""",
    "explained": """SELECT applicant_id, cast(row_number() OVER (PARTITION BY applicant_id ORDER BY points_lost DESC, feature) AS int) AS rank,
        feature, value, bin_index, points, points_lost, bad_rate FROM test_bins JOIN points USING (feature, bin_index)""",
}
_W = with_("train_long", "fixed_edges", extra=MODEL)
_DESCRIBE = "CASE feature " + " ".join(f"WHEN '{f}' THEN '{ex.describe(f)}'" for f in FEATURES) + " END"

def fixed_order_logit(prefix: str, swapped: str | None = None, other: str = "") -> str:
    """The dot product in the order of the features, so equal bins give equal sums."""
    terms = [f"{b}::double * {other if f == swapped else prefix}{f}" for f, b in BETAS.items()]
    return "(" + f"{INTERCEPT}::double + " + " + ".join(terms) + ")"


_KEY = md5u(f"cast(applicant_id AS varchar) || '|{SEED}'", 15)
_NEXT = "OVER (ORDER BY key, applicant_id)"
_PERMUTED = {
    **MODEL,
    "test_wide": "SELECT applicant_id, max(y) AS y, " + ", ".join(f"max(coalesce(woe, 0)) FILTER (feature = '{f}') AS w_{f}" for f in FEATURES)
    + " FROM test_bins LEFT JOIN woe USING (feature, bin_index) GROUP BY 1",
    "keyed": f"SELECT *, {_KEY} AS key FROM test_wide",
    "donated": "SELECT *, " + ", ".join(f"coalesce(lead(w_{f}) {_NEXT}, first_value(w_{f}) {_NEXT}) AS d_{f}" for f in FEATURES) + " FROM keyed",
    "variants": " UNION ALL ".join(
        f"SELECT '{f or '(none)'}' AS variant, y, {fixed_order_logit('w_', f, 'd_')} AS p FROM donated" for f in (None, *FEATURES)
    ),
    "per_logit": "SELECT variant, p, sum(y) AS b, count(*) - sum(y) AS g FROM variants GROUP BY 1, 2",
    "ranked": "SELECT *, sum(g) OVER (PARTITION BY variant ORDER BY p) AS cg FROM per_logit",
    "aucs": "SELECT variant, sum(cast(b AS double) * (cg - g + g / 2::double)) / (sum(b)::double * sum(g)::double) AS auc FROM ranked GROUP BY 1",
}
_STEPS = "SELECT * FROM (VALUES " + ", ".join(f"('{f}', {a}::double, {b}::double)" for f, g in GRIDS.items() for a, b in zip(g, g[1:])) + ") AS t(feature, from_value, to_value)"

ORACLES = {
    "e03_isotonic": with_("scored", extra={
        "t": "SELECT p, row_number() OVER (ORDER BY p) AS i, sum(sum(y)) OVER (ORDER BY p) AS cb, sum(count(*)) OVER (ORDER BY p) AS cn, sum(y) AS b, count(*) AS n FROM scored GROUP BY p",
        "spans": "SELECT l.i AS l, r.i AS r, (r.cb - l.cb + l.b)::double / (r.cn - l.cn + l.n)::double AS rate FROM t l JOIN t r ON l.i <= r.i",
    }) + """SELECT p, round(max(low), 6) AS calibrated FROM (
        SELECT t.p, l, min(rate) AS low FROM t JOIN spans ON l <= t.i AND r >= t.i GROUP BY 1, 2) GROUP BY 1""",
    "e14_published_scorecard": _W + "SELECT applicant_id, round(pd, 6) AS probability_of_default, score, band FROM decided",
    "g08_permutation_importance": with_("train_long", "fixed_edges", extra=_PERMUTED)
    + """SELECT variant AS feature, round(auc, 6) AS permuted_auc, round((SELECT auc FROM aucs WHERE variant = '(none)') - auc, 6) AS auc_loss
        FROM aucs WHERE variant <> '(none)'""",
    "h11_monotone_score_fixed_model": with_("train_long", "fixed_edges", extra={**MODEL, "steps": _STEPS}) + """
        SELECT feature, from_value, to_value, n AS applicants, CASE WHEN beta * (b.woe - a.woe) < -1e-9 THEN n ELSE 0 END AS score_rises
        FROM steps JOIN fixed_edges USING (feature) JOIN betas USING (feature) JOIN (SELECT count(*) AS n FROM gold WHERE split = 'test') ON true
        JOIN woe a ON a.feature = steps.feature AND a.bin_index = len(list_filter(edges, lambda e: e < from_value))
        JOIN woe b ON b.feature = steps.feature AND b.bin_index = len(list_filter(edges, lambda e: e < to_value))""",
    "e05_calibrated_pd": _W + "SELECT applicant_id, round(pd, 6) AS probability_of_default FROM decided",
    "e06_raw_score": _W + "SELECT applicant_id, round(raw_score, 6) AS raw_score FROM decided",
    "e07_score_scaling": with_("scored") + f"SELECT id, round({score_sql('p')}, 6) AS score FROM scored",
    "e08_score_to_probability": with_("scored") + "SELECT id, round(p, 6) AS p FROM scored",
    "e09_bands": with_("scored") + f"SELECT id, {band_sql(score_sql('p'), sc.DEFAULT_BANDS)} AS band FROM scored",
    "e10_decision_fixed_model": _W + "SELECT applicant_id, round(pd, 6) AS probability_of_default, score, band FROM decided",
    "e11_band_counts": _W + "SELECT band, count(*) AS applicants FROM decided GROUP BY 1",
    "e12_decision_struct": _W + "SELECT applicant_id, round(pd, 6) AS probability_of_default, score, band FROM decided",
    "g01_points_fixed_model": _W + f"""SELECT feature, {_DESCRIBE} AS description, bin_index, {bin_label()} AS bin, count, round(bad_rate, 6) AS bad_rate, round(woe, 6) AS woe,
        points, max_points_for_feature, points_lost FROM points JOIN fixed_edges USING (feature)""",
    "g03_contributions": _W + f"""SELECT applicant_id, rank, feature, {_DESCRIBE} AS description, value, bin_index, {bin_label()} AS bin, points, points_lost,
        round(bad_rate, 6) AS bin_bad_rate FROM explained JOIN fixed_edges USING (feature)""",
    "g04_reason_codes": _W + f"""SELECT applicant_id, rank, feature, {_DESCRIBE} AS reason, value AS applicant_value, coalesce(cast(value AS varchar), '{ex.NOT_REPORTED}') AS shown_value, {bin_label()} AS bin, round(points_lost, 1) AS points_lost,
        round(bad_rate, 4) AS bin_default_rate FROM explained JOIN fixed_edges USING (feature) WHERE points_lost > 0.5 AND rank <= 4""",
    "g05_importance": _W + f"""SELECT feature, {_DESCRIBE} AS description, min(points) AS min, max(points) AS max, round(max(points) - min(points), 2) AS points_range,
        round(sum(count * abs(points - mean)) / sum(count), 2) AS population_weighted_spread, round(max(count) / sum(count), 3) AS largest_bin_share
        FROM points JOIN (SELECT feature, sum(points * count) / sum(count) AS mean FROM points GROUP BY 1) USING (feature) GROUP BY 1""",
    "g07_reconstruct": _W + f"""SELECT count(*) AS applicants, max(abs(total - raw_score)) < 0.1 AS within_a_tenth FROM decided JOIN
        (SELECT applicant_id, sum(coalesce(points, ({OFFSET} - {FACTOR} * {INTERCEPT}::double) / {len(BETAS)})) AS total
         FROM test_bins LEFT JOIN points USING (feature, bin_index) GROUP BY 1) USING (applicant_id)""",
    "g09_shown_values": _W + """SELECT feature, count(*) FILTER (value IS NULL) AS not_reported, count(*) AS reasons FROM explained
        WHERE points_lost > 0.5 AND rank <= 4 GROUP BY 1""",
}
