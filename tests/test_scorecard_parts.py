"""Bins, selection, scaling, decisions and explanation on small known inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.functions.columns import DEFAULT_BANDS, ScoreScaling, assign_band, bin_index, iv_strength, left_closed_index, psi_verdict
from gradus.operators import explain as ex
from gradus.operators import fitting as fit
from gradus.operators import scoring as sc
from gradus.operators import selection as sel
from gradus.operators import woe

RNG = np.random.default_rng(5)


@pytest.fixture(scope="module")
def credit(spark):
    """Utilisation raises risk, income lowers it; a tenth of incomes is missing."""
    n = 4000
    util = RNG.uniform(size=n)
    income = RNG.lognormal(8, 0.5, n)
    noise = RNG.uniform(size=n)
    logit = -3 + 3.5 * util - 0.6 * np.log(income / 3000) + RNG.normal(0, 0.4, n)
    y = (RNG.uniform(size=n) < 1 / (1 + np.exp(-logit))).astype(int)
    rows = [(i, float(util[i]), None if i % 10 == 0 else float(income[i]), float(noise[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "applicant_id long, util double, income double, noise double, y int").repartition(4), rows


def brute_merge(x, y, edges, fraction):
    """An independent, literal statement of the two merge rules."""
    bins = [[0.0, 0.0] for _ in range(len(edges) + 1)]
    for v, t in zip(x, y):
        bins[sum(v > e for e in edges)][t] += 1
    edges = list(edges)
    need = max(1.0, fraction * len(x))

    def join(i):
        bins[i + 1] = [bins[i][0] + bins[i + 1][0], bins[i][1] + bins[i + 1][1]]
        bins.pop(i)
        edges.pop(i)

    again = True
    while again and len(bins) > 1:
        again = False
        for i, b in enumerate(bins):
            if sum(b) < need:
                join(i if i + 1 < len(bins) else i - 1)
                again = True
                break
    rate = lambda: [b / max(g + b, 1.0) for g, b in bins]
    r = rate()
    up = True
    if len(r) > 1 and not np.allclose(r, r[0]):
        up = not np.corrcoef(range(len(r)), r)[0, 1] < 0
    while len(bins) > 1:
        r = rate()
        steps = [(b - a) * (1 if up else -1) for a, b in zip(r, r[1:])]
        if min(steps) >= 0:
            break
        join(steps.index(min(steps)))
    return edges, bins


def test_bins_match_brute_force(spark, credit):
    df, rows = credit
    fitted = woe.woe_fit(df, ["util", "income", "noise"], "y")
    for position, name in ((1, "util"), (2, "income"), (3, "noise")):
        pairs = [(r[position], r[4]) for r in rows if r[position] is not None]
        x, y = [p[0] for p in pairs], [p[1] for p in pairs]
        start = sorted({float(v) for v in np.quantile(x, [i / 8 for i in range(1, 8)]).round(10)})
        edges, bins = brute_merge(x, y, start, 0.05)
        f = fitted.features[name]
        assert f.edges == pytest.approx(edges, abs=1e-12)
        assert [(b.goods, b.bads) for b in f.finite] == [(int(g), int(b)) for g, b in bins]
        rates = [b.bad_rate for b in f.finite]
        assert rates == sorted(rates) or rates == sorted(rates, reverse=True)
    assert fitted.features["income"].bins[-1].label == "Missing"
    assert fitted.features["util"].missing_woe == 0.0
    assert fitted.features["noise"].information_value < 0.05 < fitted.features["util"].information_value


def test_single_class_constant_and_all_null(spark):
    df = spark.createDataFrame([(float(i), 0) for i in range(100)], "x double, y int")
    with pytest.raises(ValueError):
        woe.woe_fit(df, ["x"], "y")
    flat = spark.createDataFrame([(1.0, None, i % 2) for i in range(40)], "x double, z double, y int")
    fitted = woe.woe_fit(flat, ["x", "z"], "y")
    assert fitted.features["x"].edges == [] and fitted.features["x"].finite[0].label == "(-inf, inf)"
    assert fitted.features["z"].bins[-1].count == 40
    with pytest.raises(KeyError):
        woe.woe_transform(flat, fitted, ["other"])


def test_bin_edges_are_right_closed_for_woe_left_closed_for_stability(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.0, 1.5, 2.0, 2.5, None)], "v double")
    got = df.select("v", bin_index("v", [1.0, 2.0]).alias("w"), left_closed_index("v", [1.0, 2.0]).alias("s")).collect()
    assert [(r["w"], r["s"]) for r in got] == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (-1, None)]


def test_text_and_nan_count_as_missing(spark, credit):
    df, _ = credit
    fitted = woe.woe_fit(df, ["income"], "y")
    odd = spark.createDataFrame([("NaN",), ("abc",), (None,), (" 2500 ",)], "income string")
    got = [r["woe_income"] for r in woe.woe_transform(odd, fitted).collect()]
    assert got[:3] == [fitted.features["income"].missing_woe] * 3 and got[3] in fitted.features["income"].woe


def test_labels_and_strength(spark):
    assert woe._labels([1.0, 2.5]) == ["(-inf, 1]", "(1, 2.5]", "(2.5, inf)"]
    df = spark.createDataFrame([(0.01,), (0.05,), (0.2,), (0.4,), (0.9,)], "v double")
    assert [r[0].split(" ")[0] for r in df.select(iv_strength(F.col("v"))).collect()] == ["unpredictive", "weak", "medium", "strong", "suspiciously"]
    assert [r[0] for r in df.select(psi_verdict(F.col("v"))).collect()] == ["stable", "stable", "investigate", "revalidate", "revalidate"]


def test_correlation_pruning_keeps_the_stronger(spark):
    a = RNG.normal(size=300)
    rows = [(float(v), float(2 * v + 0.01 * RNG.normal()), float(RNG.normal()), 3.0) for v in a]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double")
    pairs = sel.correlation_pairs(df, ["a", "b", "c", "flat"])
    values = {(r["a"], r["b"]): r["corr"] for r in pairs.collect()}
    m = np.corrcoef(np.array(rows)[:, :3].T)
    assert values["a", "b"] == pytest.approx(m[0, 1]) and values["a", "c"] == pytest.approx(m[0, 2])
    assert values["a", "flat"] is None
    kept, dropped = sel.prune_correlated(pairs, ["b", "a", "c", "flat"])
    assert kept == ["b", "c", "flat"] and dropped == {"a": "correlated 1.00 with b"}


def test_selection_reasons(spark, credit):
    df, _ = credit
    df = df.withColumn("twin", F.col("util") * 2).withColumn("mostly", F.when(F.col("y") == 1, F.lit(None)).otherwise(F.lit(1.0)))
    names = ["util", "income", "noise", "twin", "mostly"]
    report = {r["feature"]: r for r in sel.select_features(df, woe.woe_fit(df, names, "y"), "y").report(spark).collect()}
    assert report["mostly"]["exclusion_reason"].startswith("single populated bin")
    assert "correlated 1.00 with" in (report["twin"]["exclusion_reason"] or report["util"]["exclusion_reason"])
    assert report["income"]["selected"]


def test_logistic_fit_matches_newton(spark, credit):
    df, _ = credit
    bins = woe.woe_fit(df, ["util", "income"], "y")
    card = fit.fit_champion(df, bins, "y")
    pdf = woe.woe_transform(df, bins).select("woe_util", "woe_income", "y").toPandas().to_numpy()
    x, y = np.column_stack([np.ones(len(pdf)), pdf[:, :2]]), pdf[:, 2]
    b, penalty = np.zeros(3), np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b = b - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ b)
    assert [card.intercept, *card.coefficients.values()] == pytest.approx(list(b), abs=1e-4)


def pav(points):
    """Pool adjacent violators on (x, mean, weight)."""
    blocks = []
    for x, m, w in sorted(points):
        blocks.append([m, w, [x]])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            m2, w2, xs = blocks.pop()
            m1, w1, xs1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, xs1 + xs])
    return {x: m for m, _, xs in blocks for x in xs}


def test_isotonic_and_platt(spark):
    rows = [(round(0.05 * (i % 15), 2), int(RNG.uniform() < 0.04 * (i % 15))) for i in range(900)]
    df = spark.createDataFrame(rows, "p double, y int")
    curve = fit.fit_calibrator(df, "p", "y")
    groups = {}
    for p, y in rows:
        groups.setdefault(p, []).append(y)
    want = pav([(p, np.mean(v), len(v)) for p, v in groups.items()])
    got = {r["p"]: r["c"] for r in curve.add(df.select("p").distinct(), "p", "c").collect()}
    assert got == pytest.approx(want)
    ends = spark.createDataFrame([(-5.0,), (9.0,)], "p double")
    assert [r["c"] for r in curve.add(ends, "p", "c").collect()] == pytest.approx([curve.predictions[0], curve.predictions[-1]])
    platt = fit.fit_calibrator(df, "p", "y", "platt")
    assert platt.slope > 0
    with pytest.raises(ValueError):
        fit.fit_calibrator(df, "p", "y", "spline")


def test_scale_and_bands(spark):
    s = ScoreScaling()
    df = spark.createDataFrame([(1 / 51,), (1 / 101,), (0.0,), (1.0,)], "p double")
    base, double, *ends = [r[0] for r in df.select(s.to_score(F.col("p"))).collect()]
    assert base == pytest.approx(600) and double - base == pytest.approx(20) and all(math.isfinite(v) for v in ends)
    back = df.limit(2).select(s.to_probability(s.to_score(F.col("p")))).collect()
    assert [r[0] for r in back] == pytest.approx([1 / 51, 1 / 101])
    scores = spark.createDataFrame([(615.0,), (614.99,), (545.0,), (0.0,), (-40.0,)], "s double")
    for bands in (DEFAULT_BANDS, tuple(reversed(DEFAULT_BANDS))):
        assert [r[0] for r in scores.select(assign_band(F.col("s"), bands)).collect()] == ["A", "B", "D", "E", "E"]


@pytest.fixture(scope="module")
def card(spark, credit):
    df, _ = credit
    fitted = fit.fit_champion(df, woe.woe_fit(df, ["util", "income"], "y"), "y")
    raw = sc.add_log_odds(df, fitted, "_l").select(sc.sigmoid(F.col("_l")).alias("p"), "y")
    return fitted.with_calibrator(fit.fit_calibrator(raw, "p", "y"))


def test_score_is_half_even_and_missing_features_fail(spark, credit, card):
    df, _ = credit
    raw = spark.createDataFrame([(544.5,), (545.5,), (575.2,)], "raw_score double")
    assert [(r["score"], r["band"]) for r in sc.with_decision(raw).collect()] == [(544, "E"), (546, "D"), (575, "C")]
    with pytest.raises(KeyError):
        sc.score(df.drop("util"), card)
    pds = sc.decide(df, card).agg(F.min("probability_of_default"), F.max("probability_of_default")).first()
    assert 1e-6 <= pds[0] <= pds[1] <= 1 - 1e-6


def test_points_reasons_and_reconstruction(spark, credit, card):
    df, _ = credit
    points = ex.points_table(spark, card)
    best = points.groupBy("feature").agg(F.min("points_lost")).collect()
    assert all(r[1] == 0.0 for r in best)
    assert ex.reconstruct(df, card, points).first()["max_abs_difference"] < 0.1
    contributions = ex.explain(df, card, points)
    assert contributions.count() == 2 * 4000
    reasons = ex.reason_codes(df, card, points)
    assert reasons.where("points_lost <= 0.4 or rank > 4").count() == 0
    assert reasons.where("applicant_value is null").where("shown_value <> 'not reported'").count() == 0
    lost = contributions.groupBy("applicant_id").agg(F.sort_array(F.collect_list(F.struct("rank", "points_lost"))).alias("l"))
    assert all(r["l"][0][1] >= r["l"][1][1] for r in lost.collect())
    assert ex.reason_lists(df, card, points).count() == 4000
    importance = ex.global_importance(points).collect()
    assert importance[0]["feature"] == "util"


def test_untrained_missing_bin_is_skipped(spark, credit, card):
    points = ex.points_table(spark, card)
    row = spark.createDataFrame([(1, None, 100.0)], "applicant_id long, util double, income double")
    assert [r["feature"] for r in ex.explain(row, card, points).collect()] == ["income"]


def test_monotone_audit_and_save(spark, credit, card, tmp_path):
    df, _ = credit
    audit = ex.monotone_score_audit(df.limit(50), card, "util", [0.0, 0.3, 0.6, 0.9]).collect()
    assert len(audit) == 3 and all(r["score_rises"] == 0 for r in audit)
    card.save(spark, str(tmp_path / "card"))
    again = sc.Scorecard.load(spark, str(tmp_path / "card"))
    assert again.coefficients == card.coefficients and again.calibrator == card.calibrator
    a, b = (sorted(map(tuple, sc.decide(df, c).collect())) for c in (card, again))
    assert a == b


def test_permutation_importance_ranks_signal_over_noise(spark, credit, card):
    df, _ = credit
    got = fit.permutation_importance(
        df, ["util", "income", "noise"], "y", "applicant_id", lambda d, out: sc.add_log_odds(d, card, out), rows_per_bucket=500
    )
    loss = {r["feature"]: r["auc_loss"] for r in got.collect()}
    assert loss["util"] > 0.05 > abs(loss["noise"]) and loss["noise"] == 0.0


def test_challenger_handles_missing_values(spark, credit):
    df, _ = credit
    half = F.col("applicant_id") % 2 == 0
    model = fit.fit_challenger(df.where(half), df.where(~half), ["util", "income"], "y", max_iter=5)
    scored = model.score(df)
    assert scored.count() == 4000 and scored.where("probability_of_default is null").count() == 0
