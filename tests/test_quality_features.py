"""Silver rules, gold features, drift, ledger and text on small known inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import drift as dr
from gradus.operators import evaluation as ev
from gradus.operators import features as feat
from gradus.operators import ledger as lg
from gradus.operators import quality as q
from gradus.operators import text as tx


# --- silver and gold ----------------------------------------------------------------------
def bronze(spark, rows):
    names = list(q.NUMERIC_SCHEMA)
    base = {n: "1" for n in names}
    full = [{**base, "applicant_id": str(i), "age": str(30 + i), **r} for i, r in enumerate(rows, 1)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], ", ".join(f"{n} string" for n in names))


def test_rules_and_counters(spark):
    rows = [
        {"monthly_income": "NA", "debt_ratio": "500"}, {"times_90_dpd": "98", "dependents": ""}, {"age": "0"}, {"age": "101"},
        {"revolving_utilisation": "50708"}, {"monthly_income": None, "debt_ratio": "NaN"}, {"monthly_income": "60000"}, {"dependents": " 3 "},
    ]
    raw = bronze(spark, rows)
    copies = raw.where("applicant_id = '8'").withColumn("applicant_id", F.lit("900"))
    silver, report = q.build_silver(raw.unionByName(copies))
    got = {(r["rule"], r["column"]): r["records"] for r in report.collect()}
    assert got["rows_in", None] == 9 and got["rows_out", None] == 8 and got["exact_duplicates_removed", None] == 1
    assert got["delinquency_sentinel_rows", None] == 1 and got["invalid_age_rows", None] == 2
    assert got["debt_ratio_unit_ambiguous_rows", None] == 1
    assert got["missing_rows", "monthly_income"] == 2 and got["missing_rows", "dependents"] == 1
    assert got["values_winsorised", "revolving_utilisation"] == 1 and got["values_winsorised", "monthly_income"] == 1
    assert got["unparseable_values_nulled", "monthly_income"] == 1 and ("unparseable_values_nulled", "dependents") not in got
    by = {r["applicant_id"]: r for r in silver.collect()}
    assert by[1]["monthly_debt_amount"] == 500.0 and by[1]["debt_ratio"] is None and by[1]["flag_debt_ratio_is_amount"] == 1
    assert by[2]["times_90_dpd"] is None and by[2]["flag_delinquency_sentinel"] == 1
    assert by[3]["age"] is None and by[5]["revolving_utilisation"] == 2.0 and by[7]["monthly_income"] == 50000.0
    assert by[6]["debt_ratio"] is None and by[6]["flag_debt_ratio_is_amount"] is None
    assert by[8]["dependents"] == 3.0 and 900 not in by
    assert "rows_in" in q.quality_document(report).first()["document"]


def test_dedupe_keeps_the_lowest_id_and_provenance(spark):
    rows = [(3, None, "x"), (1, None, "y"), (2, 5.0, "z")]
    df = spark.createDataFrame(rows, "applicant_id long, v double, source_file string")
    got = sorted(map(tuple, q.drop_exact_duplicates(df).collect()))
    assert got == [(1, None, "y"), (2, 5.0, "z")]


def test_expectations_and_require(spark):
    gold = spark.createDataFrame([(1, 0, "train"), (1, 1, "test"), (2, None, "train")], f"applicant_id long, {feat.TARGET} int, split string")
    checks = q.gold_expectations(gold)
    assert {r["check"]: r["passed"] for r in checks.collect()} == {"unique_ids": False, "null_targets": False, "splits": False, "default_rate": False}
    with pytest.raises(RuntimeError):
        q.require(checks)


def test_imputation_keeps_the_unknown_band_and_replays(spark):
    rows = [(1, 25.0, 1000.0), (2, 26.0, 3000.0), (3, 27.0, None), (4, None, None), (5, 65.0, None)]
    raw = spark.createDataFrame(rows, "applicant_id long, age double, monthly_income double")
    silver = raw.withColumns({c: F.lit(1.0) for c in feat.RAW_INPUTS if c not in raw.columns})
    constants = feat.fit_constants(silver)
    assert constants.income_by_band["18-29"] == 1000.0 and constants.income == 1000.0 and constants.age == 26.0
    again = feat.ImputationConstants.from_frame(constants.to_frame(spark))
    assert again == constants
    out = {r["applicant_id"]: r for r in feat.derive_features(raw, again).collect()}
    assert out[4]["age_band"] == "unknown" and out[4]["age"] == 26.0
    assert out[1]["monthly_debt_amount"] == 0.0 and out[1]["flag_delinquency_sentinel"] == 0
    assert out[1]["delinquencies_per_credit_line"] == 0.0 and out[1]["unsecured_lines"] == 0.0


def test_severity_and_ratios(spark):
    row = spark.createDataFrame(
        [(0.5, 40.0, 0.5, 2000.0, 4.0, 1.0, 1.0, 2.0, 1.0, None)], ", ".join(f"{c} double" for c in feat.RAW_INPUTS)
    )
    r = feat.derive_features(row, feat.ImputationConstants()).first()
    assert r["total_delinquencies"] == 3.0 and r["worst_delinquency_severity"] == 2.0 and r["delinquencies_per_credit_line"] == 0.75
    assert r["monthly_debt_service"] == 1000.0 and r["income_per_dependent"] == 1000.0 and r["utilisation_x_delinquency"] == 2.0
    assert r["log_monthly_income"] == pytest.approx(math.log1p(2000.0))


def test_split_is_stable_under_repartitioning(spark):
    ids = spark.range(3000).withColumnRenamed("id", "applicant_id")
    for method in ("murmur3", "md5"):
        a, b = (sorted(map(tuple, feat.hash_split(ids.repartition(k), method=method).collect())) for k in (1, 8))
        assert a == b
        shares = {s: sum(1 for r in a if r[1] == s) / 3000 for s in ("train", "valid", "test")}
        assert shares["train"] == pytest.approx(0.6, abs=0.05) and shares["test"] == pytest.approx(0.2, abs=0.05)


# --- measurement --------------------------------------------------------------------------
def test_perfect_reversed_and_constant_scores(spark):
    p = [0.1, 0.2, 0.3, 0.7, 0.8, 0.9]
    df = spark.createDataFrame([(v, int(i > 2), int(i < 3), 0.5) for i, v in enumerate(p)], "p double, y int, z int, flat double")
    assert ev.auc_gini(df, "p", "y").first()["gini"] == 1.0 and ev.auc_gini(df, "p", "z").first()["gini"] == -1.0
    assert ev.ks(df, "p", "y").first()["ks"] == 1.0 and ev.ks(df, "flat", "y").first()["ks"] == 0.0
    one = df.where("y = 1")
    assert ev.ks(one, "p", "y").first()["ks"] == 0.0 and ev.auc_gini(one, "p", "y").first()["auc"] is None


def test_segments_keep_a_null_segment(spark):
    df = spark.createDataFrame([(None if i % 2 else "s", (i % 7) / 10, int(i % 3 == 0)) for i in range(60)], "g string, p double, y int")
    got = {r["g"]: r["n"] for r in ev.segment_report(df, "p", "y", "g", min_rows=10).collect()}
    assert got == {None: 30, "s": 30}


def numpy_psi(a, b, bins=10):
    edges = np.unique(np.percentile(a, np.linspace(0, 100, bins + 1)))
    edges[0], edges[-1] = -np.inf, np.inf
    e, c = (np.maximum(np.histogram(v, bins=edges)[0] / len(v), 1e-4) for v in (a, b))
    return float(np.sum((c - e) * np.log(c / e)))


def test_psi_matches_numpy_and_sees_counters_drift(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 3000), rng.normal(1.2, 1, 3000)
    zeros = np.zeros(3000)
    zeros[:150] = 1
    drifted = zeros.copy()
    drifted[:1500] = 5
    left = spark.createDataFrame([(float(x), float(z)) for x, z in zip(a, zeros)], "v double, c double")
    right = spark.createDataFrame([(float(x), float(z)) for x, z in zip(b, drifted)], "v double, c double")
    got = {r["feature"]: r["psi"] for r in dr.psi(left, right, ["v", "c"]).collect()}
    assert got["v"] == pytest.approx(numpy_psi(a, b)) and got["c"] > 1.0
    same = {r["feature"]: r["psi"] for r in dr.psi(left, left, ["v", "c"]).collect()}
    assert same == pytest.approx({"v": 0.0, "c": 0.0})
    report = dr.drift_report(left, right, ["c"], "v")
    assert report.summary.first()["score_verdict"] == "revalidate"
    with pytest.raises(RuntimeError):
        dr.stop_the_line(report)


def test_gate(spark):
    metrics = spark.createDataFrame([(0.7, 0.55, 0.05)], "gini double, ks double, brier double")
    mono = spark.createDataFrame([(True,)], "bands_monotonic boolean")
    stable = spark.createDataFrame([(0.01, "stable")], "psi double, verdict string")
    assert dr.promoted(dr.promotion_gate(metrics, mono, stable)).first()["promoted"]
    assert not dr.promoted(dr.promotion_gate(metrics.withColumn("ks", F.lit(0.4)), mono, stable)).first()["promoted"]


def test_stress_is_independent_of_partitioning(spark):
    df = spark.range(200).select(F.col("id").alias("applicant_id"), (F.col("id") % 80 + 18).cast("double").alias("age"))
    a, b = (sorted(map(tuple, dr.stress_shift(df.repartition(k), "applicant_id").collect())) for k in (1, 7))
    assert a == b and all(18 <= r[1] <= 100 for r in a)
    same = dr.stress_shift(df, "applicant_id", intensity=0.0).collect()
    assert sorted(r[1] for r in same) == sorted(r[1] for r in df.collect())


# --- ledger and text ----------------------------------------------------------------------
def tiny_ledger(spark):
    rows = []
    for m in range(6):
        rows += [(1, m * 30, f"ACME PAY {m}", 2000.0, 2100.0, "income"), (1, m * 30 + 3, "RENT 77", -800.0, 1300.0, "housing"),
                 (1, m * 30 + 9, f"SHOP {m}", -50.0 - 40 * m, -5.0, "groceries")]
    rows += [(2, 1, "CASH 1", -20.0, -20.0, "cash"), (2, 1, "CASH 2", -30.0, -50.0, "cash"), (2, 200, "ODD", 0.0, -50.0, "fees")]
    return spark.createDataFrame(rows, "applicant_id long, day int, description string, amount double, balance_after double, category string")


def test_cashflow(spark):
    got = {r["applicant_id"]: r for r in lg.cashflow_features(tiny_ledger(spark)).collect()}
    a, b = got[1], got[2]
    assert a["ob_income_monthly_median"] == 2000.0 and a["ob_income_payment_count"] == 6 and a["ob_income_is_regular"] == 1.0
    groceries = sum(50.0 + 40 * m for m in range(6))
    assert a["ob_essential_spend_monthly"] == pytest.approx((4800 + groceries) / 6) and a["ob_essential_spend_ratio"] == 1.0
    assert a["ob_discretionary_spend_monthly"] is None and a["ob_discretionary_spend_ratio"] == 0.0
    assert a["ob_days_in_overdraft"] == 6.0 and b["ob_days_in_overdraft"] == 2.0
    assert a["ob_surplus_after_essentials"] == pytest.approx(2000 - a["ob_essential_spend_monthly"])
    months = [850.0 + 40 * m for m in range(6)]
    assert a["ob_spend_volatility"] == pytest.approx(np.std(months, ddof=1) / np.mean(months))
    assert b["ob_income_monthly_median"] is None and b["ob_income_is_regular"] == 0.0 and b["ob_cash_monthly"] == pytest.approx(50 / 6)
    assert b["ob_fee_events"] == 1.0 and b["ob_essential_cover_ratio"] is None
    assert b["ob_spend_volatility"] == pytest.approx(np.std([50.0, 0, 0, 0, 0, 0], ddof=1) / (50 / 6))


def test_behaviour(spark):
    rows = lg.behavioural_features(tiny_ledger(spark)).collect()
    rent = [r for r in rows if r["merchant_stem"] == "RENT"]
    assert len(rows) == 21 and {r["merchant_frequency"] for r in rent} == {6} and {r["merchant_is_monthly"] for r in rent} == {1.0}
    odd = next(r for r in rows if r["merchant_stem"] == "ODD")
    assert odd["merchant_amount_cv"] == 0.0 and odd["share_of_month_outflow"] == 0.0


def test_holdout_takes_whole_merchants(spark):
    rows = [(1, f"{c} {chr(65 + i)}{chr(65 + i)} {n}", c, -1.0) for c, k in (("x", 9), ("y", 2), ("z", 3)) for i in range(k) for n in range(3)]
    df = spark.createDataFrame(rows, "applicant_id long, description string, true_category string, amount double")
    held = lg.holdout_merchants(df)
    assert {r["true_category"]: r["count"] for r in held.groupBy("true_category").count().collect()} == {"x": 2, "z": 1}
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, lg.holdout_merchants(df.repartition(6), rows_per_bucket=2).collect()))
    train, test = lg.split_by_merchant(df, held)
    assert train.count() + test.count() == len(rows) and train.join(test, "merchant_stem").count() == 0


def ngrams(text):
    out = []
    for word in text.lower().split():
        w = f" {word} "
        for n in range(2, min(5, len(w)) + 1):
            out += [w[i : i + n] for i in range(len(w) - n + 1)]
    return out


def test_ngrams_and_tfidf_match_brute_force(spark):
    docs = ["ACME Pay 1", "a  bc", "acme", "acme", "RENT Rent rent"]
    df = spark.createDataFrame([(d,) for d in docs], "description string")
    got = {r["description"]: sorted(r["g"]) for r in df.distinct().select("description", tx.char_ngrams(F.col("description")).alias("g")).collect()}
    assert got == {d: sorted(ngrams(d)) for d in set(docs)}
    df_of = {}
    for d in docs:
        for g in set(ngrams(d)):
            df_of[g] = df_of.get(g, 0) + 1
    idf = {g: math.log((1 + len(docs)) / (1 + n)) + 1 for g, n in df_of.items() if n >= 2}
    fitted = tx.fit_idf(df)
    assert {r["gram"]: r["idf"] for r in fitted.collect()} == pytest.approx(idf)
    weights = {(r["description"], r["gram"]): r["weight"] for r in tx.tfidf(tx.description_counts(df), fitted).collect()}
    for d in set(docs):
        raw = {g: (1 + math.log(ngrams(d).count(g))) * idf[g] for g in set(ngrams(d)) if g in idf}
        size = math.sqrt(sum(v * v for v in raw.values()))
        for g, v in raw.items():
            assert weights[d, g] == pytest.approx(v / size)


def test_categoriser_learns_known_merchants(spark):
    rows = [(i % 5, 30 * (i % 6), f"{w} {i % 4}", -float(5 + i % 3), c) for i in range(120) for w, c in (("GROCER", "food"), ("LANDLORD", "rent"), ("9", "other"))]
    df = spark.createDataFrame(rows, "applicant_id long, day int, description string, amount double, true_category string")
    text = tx.fit_categoriser(df, behaviour=False, max_iter=30).transform(df)
    assert tx.accuracy(text).first()["accuracy"] == 1.0
    shaped = lg.behavioural_features(df)
    both = tx.fit_categoriser(shaped, behaviour=True, max_iter=30).transform(shaped)
    assert tx.accuracy(both).first() == (1.0, 360)
    assert {r["label"]: r["f1"] for r in tx.class_report(both).collect()} == {"food": 1.0, "rent": 1.0, "other": 1.0}
    unseen = spark.createDataFrame([("ZZQQ", "food")], "description string, true_category string")
    assert tx.fit_categoriser(df, behaviour=False, max_iter=5).transform(unseen).count() == 1
