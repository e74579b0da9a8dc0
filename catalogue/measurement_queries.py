"""Ranking, calibration, profit, bands, segments, drift and gates."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogue.ctes import bins_over, md5u, with_
from catalogue.fixed import BETAS, FIXED_EDGES, SEED
from catalogue.inputs import fixed_card, gold, r6, splits
from catalogue.scoring_queries import FACTOR, MODEL, OFFSET, band_sql, fixed_order_logit, score_sql
from gradus.functions.columns import ScoreScaling, with_row
from gradus.operators import drift as dr
from gradus.operators import evaluation as ev
from gradus.operators import scoring as sc
from gradus.operators.features import MODEL_FEATURES, TARGET
from gradus.operators.quality import gold_expectations
from gradus.plans import lake, monitoring
from gradus.sources import published
from gradus.sources.retail import drift_pair, scored
from gradus.sources.tables import materialise, read_appended, save_named_table, staging_dir, take_split

SCALE = ScoreScaling()
# Bands that spread the scores of the ``scored`` view.
BANDS = (("A", 590.0, "Very low risk"), ("B", 575.0, "Low risk"), ("C", 565.0, "Moderate risk"), ("D", 550.0, "Elevated risk"), ("E", 0.0, "High risk"))
METRICS = ("auc", "gini", "ks", "brier", "log_loss", "observed_default_rate", "mean_predicted_rate")


def f01_auc(spark, sf):
    return ev.auc_gini(scored(spark, sf), "p", "y").withColumns(r6("auc", "gini"))


def f02_ks(spark, sf):
    return ev.ks(scored(spark, sf), "p", "y").withColumns(r6("ks"))


def f03_evaluate(spark, sf):
    return ev.evaluate(scored(spark, sf), "p", "y").withColumns(r6(*METRICS))


def f04_calibration(spark, sf):
    return ev.calibration_table(scored(spark, sf), "p", "y", "id").withColumns(r6("predicted_rate", "observed_rate", "difference"))


def f05_gains(spark, sf):
    return ev.gains_table(scored(spark, sf), "p", "y", "id").withColumns(r6("bad_rate", "cumulative_bad_capture", "cumulative_population", "lift"))


def f06_approval(spark, sf):
    return ev.approval_curve(scored(spark, sf), "p", "y", "id").withColumns(r6("approval_rate", "bad_rate"))


def f07_cutoff(spark, sf):
    return ev.best_cutoff(ev.approval_curve(scored(spark, sf), "p", "y", "id")).withColumns(r6("approval_rate", "bad_rate"))


def _halves(spark, sf):
    s = scored(spark, sf).withColumn("raw_score", SCALE.to_score(F.col("p")))
    return s.where(F.col("id") % 2 == 0), s.where(F.col("id") % 2 == 1)


def f08_business(spark, sf):
    valid, test = _halves(spark, sf)
    cut = ev.best_cutoff(ev.approval_curve(valid, "p", "y", "id"))
    return ev.apply_cutoff(test, "p", "y", cut, "raw_score").withColumns(
        r6("score_cutoff", "approval_rate_on_validation", "approval_rate_on_test", "bad_rate_at_cutoff")
    )


def _decisions(spark, sf):
    raw = scored(spark, sf).withColumn("raw_score", SCALE.to_score(F.col("p")))
    return sc.with_decision(raw, BANDS)


def f09_bands(spark, sf):
    return ev.band_table(_decisions(spark, sf), "y", BANDS).withColumns(r6("population_share", "observed_default_rate"))


def f10_monotone(spark, sf):
    return ev.bands_monotonic(ev.band_table(_decisions(spark, sf), "y", BANDS))


def f11_segments(spark, sf):
    return ev.segment_report(scored(spark, sf), "p", "y", "seg").withColumns(r6("gini", "observed_default_rate", "mean_predicted_rate"))


def f12_summary(spark, sf):
    return ev.dataset_summary(gold(spark, sf), TARGET, MODEL_FEATURES).withColumns(r6("value"))


def f13_hist(spark, sf):
    s = scored(spark, sf).withColumn("score", SCALE.to_score(F.col("p")))
    return ev.score_histogram(s, "score", "y").withColumns(r6("bin_start", "density"))


# --- drift --------------------------------------------------------------------------------
_COLUMNS = ["p", "price", "arrears", "arrears_drifted"]


def h01_psi(spark, sf):
    reference, current = drift_pair(spark, sf)
    return dr.psi(reference, current, ["price", "p"]).withColumns(r6("psi"))


def h02_discrete_psi(spark, sf):
    reference, current = drift_pair(spark, sf)
    return dr.discrete_psi(reference, current, ["arrears", "arrears_drifted"]).withColumns(r6("psi"))


def h03_verdict(spark, sf):
    reference, current = drift_pair(spark, sf)
    return dr.with_verdict(dr.psi(reference, current, _COLUMNS)).select("feature", "verdict")


def _drift(spark, sf):
    reference, current = drift_pair(spark, sf)
    return dr.drift_report(reference, current, ["price", "arrears", "arrears_drifted"], "p")


def h04_drift(spark, sf):
    return _drift(spark, sf).shifts.withColumns(r6("psi"))


def h04_drift_summary(spark, sf):
    return _drift(spark, sf).summary.withColumns(r6("score_psi", "reference_mean_score", "current_mean_score"))


def _record_rows(record, *keep):
    """A monitoring record with one row per shift that it lists."""
    shifts = F.explode(F.from_json("largest_shifts", dr.SHIFTS_SCHEMA)).alias("s")
    summary = ["score_psi", "score_verdict", "reference_mean_score", "current_mean_score", "action"]
    return record.select(*keep, *summary, shifts).select(*keep, *summary, "s.*").withColumns(r6("score_psi", "reference_mean_score", "current_mean_score", "psi"))


def a11_monitoring_row(spark, sf):
    return _record_rows(_drift(spark, sf).record())


def a10_appended_decisions(spark, sf):
    """Two batches, one of them delivered twice, in the table that readers see."""
    train, _, test = splits(spark, sf)
    card = fixed_card(train)
    dest = f"{staging_dir(spark)}/decisions-{uuid.uuid4().hex}"
    for batch in (0, 1, 0):
        monitoring.score_book(test.where(F.col("applicant_id") % 2 == batch), card, dest, "1", f"day {batch}")
    seen = read_appended(spark, dest)
    return seen.select("applicant_id", F.round("probability_of_default", 6).alias("probability_of_default"), "score", "band", "model_version", "batch")


def h05_stress(spark, sf):
    test = splits(spark, sf)[2]
    out = dr.stress_shift(test, "applicant_id", SEED)
    # Plain products are bit-equal in both engines; only the logarithm needs rounding.
    return out.select(
        "applicant_id", "age", "revolving_utilisation", "utilisation_x_delinquency", "debt_ratio", "monthly_income",
        F.round("log_monthly_income", 6).alias("log_monthly_income"), "disposable_income", "income_per_dependent",
    )


def h06_control_and_treatment(spark, sf):
    rows = gold(spark, sf)
    card = fixed_card(take_split(rows, "train"))
    return _record_rows(monitoring.control_and_treatment(rows, card, SEED), "population")


def h07_train_test_psi(spark, sf):
    train, _, test = splits(spark, sf)
    card = fixed_card(train)
    return dr.with_verdict(dr.psi(sc.score(train, card), sc.score(test, card), ["probability_of_default"])).withColumns(r6("psi"))


def h08_expectations(spark, sf):
    return gold_expectations(gold(spark, sf)).withColumns(r6("value"))


def h08_published_gold(spark, sf):
    """A version with planted copies is refused, the next is published: what was audited, and what readers see."""
    root, rows = f"{staging_dir(spark)}/gold-{uuid.uuid4().hex}", materialise(gold(spark, sf))
    twice = rows.unionByName(rows.where((F.col("applicant_id") % 10 == 3) & (F.col(TARGET) == 1)))
    versions = {}
    for name, candidate in (("first", twice), ("second", rows)):
        try:
            versions[name] = lake.publish_gold(candidate, root, 8, rate_range=(0.03, 0.30))
        except published.AuditFailed as failure:
            versions[name] = failure.version
    names = spark.createDataFrame([(v, k) for k, v in versions.items()], "version string, name string")
    seen = lake.published_gold(spark, root).agg(F.count(F.lit(1)).alias("rows_seen"), F.countDistinct("applicant_id").alias("ids_seen"))
    log = published.audits(spark, root).join(F.broadcast(names), "version").join(
        F.broadcast(published.publications(spark, root).select("version", F.lit(True).alias("published"))), "version", "left"
    )
    return with_row(log, seen).select("name", "check", F.round("value", 6).alias("value"), "passed", F.coalesce("published", F.lit(False)).alias("published"), "rows_seen", "ids_seen")


def a09_bucketed_decisions(spark, sf):
    """Gold and its decisions as named tables dealt by applicant, joined without an exchange: defaults per split and band."""
    everyone, mark = materialise(gold(spark, sf)), uuid.uuid4().hex
    card = fixed_card(take_split(everyone, "train"))
    for name, rows in (("gold", everyone), ("decided", sc.decide(everyone, card))):
        save_named_table(rows, f"{name}_{mark}", keys=["applicant_id"], buckets=8, path=f"{staging_dir(spark)}/{name}-{mark}")
    joined = spark.table(f"gold_{mark}").select("applicant_id", "split", TARGET).join(spark.table(f"decided_{mark}").select("applicant_id", "band"), "applicant_id")
    return joined.groupBy("split", "band").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(TARGET).cast("bigint")).alias("bads"))


def h10_gated_decisions(spark, sf):
    """A batch whose scores moved is refused before readers see it, one of the usual population is let in."""
    train, _, test = splits(spark, sf)
    card, train, test = fixed_card(train), materialise(train), materialise(test)
    dest = f"{staging_dir(spark)}/gated-{uuid.uuid4().hex}"
    moved = test.withColumns({"revolving_utilisation": F.lit(1.2), "times_90_dpd": F.lit(3.0)})
    for batch, book in (("moved", moved), ("usual", test)):
        try:
            monitoring.score_book_gated(book, card, train, dest, "1", batch)
        except RuntimeError:  # the gate's verdict: this batch stays uncommitted
            continue
    return read_appended(spark, dest).select("applicant_id", "score", "band", "model_version", "batch")


def h09_gate(spark, sf):
    reference, current = drift_pair(spark, sf)
    metrics = ev.evaluate(scored(spark, sf), "p", "y")
    monotonic = ev.bands_monotonic(ev.band_table(_decisions(spark, sf), "y", BANDS))
    return dr.promotion_gate(metrics, monotonic, dr.with_verdict(dr.psi(reference, current, ["p"]))).withColumns(r6("value"))


QUERIES = {f.__name__: f for f in (
    f01_auc, f02_ks, f03_evaluate, f04_calibration, f05_gains, f06_approval, f07_cutoff, f08_business, f09_bands, f10_monotone, f11_segments,
    f12_summary, f13_hist, h01_psi, h02_discrete_psi, h03_verdict, h04_drift, h04_drift_summary, a10_appended_decisions, a11_monitoring_row, h05_stress,
    h06_control_and_treatment, h07_train_test_psi, h08_expectations, h08_published_gold, a09_bucketed_decisions, h10_gated_decisions, h09_gate,
)}

# --- SQL ----------------------------------------------------------------------------------
def evaluated(by: str | None) -> dict[str, str]:
    """AUC and KS from one row per score."""
    key, part, group = (f"{by}, ", f"PARTITION BY {by}", f"GROUP BY {by}") if by else ("", "", "")
    return {
        "per_score": f"SELECT {key}p, count(*) AS n, sum(y) AS b, count(*) - sum(y) AS g FROM scored GROUP BY {key}p",
        "running": f"SELECT *, sum(g) OVER ({part} ORDER BY p) AS cg, sum(b) OVER ({part} ORDER BY p) AS cb, sum(g) OVER ({part}) AS tg, sum(b) OVER ({part}) AS tb FROM per_score",
        "measured": f"""SELECT {key}sum(cast(b AS double) * (cg - g + g / 2::double)) / (max(tb)::double * max(tg)::double) AS auc, max(abs(cb::double / tb::double - cg::double / tg::double)) AS ks,
            sum(b * (1 - p) * (1 - p) + g * p * p) / sum(n) AS brier, -sum(b * ln(p) + g * ln(1 - p)) / sum(n) AS log_loss,
            sum(b)::double / sum(n)::double AS observed, sum(p * n) / sum(n) AS predicted, cast(sum(n) AS bigint) AS n FROM running {group}""",
    }


_M = with_("scored", extra=evaluated(None))


def _curve(source: str, step_filter: str = "") -> str:
    return f"""SELECT cast(step AS int) AS step, accepted / n::double AS approval_rate, accepted, bads / accepted::double AS bad_rate,
        (accepted - bads) * 450::double - bads * 2800::double AS expected_profit, p AS score_cutoff_probability
        FROM (SELECT step, n, greatest(1, cast(round_even(step / 100::double * n, 0) AS bigint)) AS accepted
              FROM range(1, 101) t(step), (SELECT count(*) AS n FROM {source}))
        JOIN (SELECT row_number() OVER (ORDER BY p, id) AS r, cast(sum(y) OVER (ORDER BY p, id) AS bigint) AS bads, p FROM {source}) ON r = accepted"""


_BAND_ROWS = f"""SELECT band, count(*) AS applicants, min(score) AS min_score, max(score) AS max_score, avg(y) AS rate
    FROM (SELECT y, cast(round_even(s, 0) AS bigint) AS score, {band_sql('s', BANDS)} AS band FROM (SELECT y, {score_sql('p')} AS s FROM scored)) GROUP BY 1"""
_BAND_NAMES = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}', '{label}')" for i, (n, _, label) in enumerate(sorted(BANDS, key=lambda b: b[1]))) + ") AS t(position, band, label)"


def stability(columns: list[str], reference: str, current: str, bins: int = 10, discrete: bool | None = None) -> dict[str, str]:
    """PSI per column: reference deciles, or common values when fewer than three edges are left."""
    ref_long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::double AS v FROM {reference} WHERE {c} IS NOT NULL" for c in columns)
    cur_long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::double AS v FROM {current} WHERE {c} IS NOT NULL" for c in columns)
    probs = [i / bins for i in range(bins + 1)]
    use_discrete = {None: "len(e) < 3", True: "true", False: "false"}[discrete]
    return {
        "ref_long": ref_long,
        "cur_long": cur_long,
        "cuts": f"""SELECT feature, {use_discrete} AS discrete, e[2:-2] AS inner_cuts FROM (
            SELECT feature, list_sort(list_distinct(quantile_cont(v, {probs}))) AS e FROM ref_long GROUP BY 1)""",
        "levels": """SELECT feature, list(v ORDER BY c DESC, v) AS levels FROM (
            SELECT feature, v, count(*) AS c, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, v) AS r FROM ref_long GROUP BY 1, 2) WHERE r <= 20 GROUP BY 1""",
        "spec": "SELECT feature, discrete, inner_cuts, levels, CASE WHEN discrete THEN len(levels) + 1 ELSE len(inner_cuts) + 1 END AS size FROM cuts JOIN levels USING (feature)",
        "placed_both": """SELECT side, feature, CASE WHEN NOT discrete THEN len(list_filter(inner_cuts, lambda x: x <= v))
              WHEN list_contains(levels, v) THEN list_position(levels, v) - 1 ELSE len(levels) END AS bin
            FROM (SELECT 'r' AS side, * FROM ref_long UNION ALL SELECT 'c', * FROM cur_long) JOIN spec USING (feature)""",
        "counted_both": "SELECT feature, bin, count(*) FILTER (side = 'r') AS r, count(*) FILTER (side = 'c') AS c FROM placed_both GROUP BY 1, 2",
        "full_bins": "SELECT feature, unnest(range(size)) AS bin FROM spec",
        "index_shares": """SELECT feature, sum(r) OVER w AS nr, sum(c) OVER w AS nc, greatest(r / (sum(r) OVER w)::double, 1e-4::double) AS e, greatest(c / (sum(c) OVER w)::double, 1e-4::double) AS a
            FROM (SELECT feature, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM full_bins LEFT JOIN counted_both USING (feature, bin)) WINDOW w AS (PARTITION BY feature)""",
        "psi": "SELECT feature, cast(nr AS bigint) AS reference_rows, cast(nc AS bigint) AS current_rows, sum((a - e) * ln(a / e)) AS psi FROM index_shares GROUP BY 1, 2, 3",
    }


_SIDES = {"drift_ref": "SELECT * FROM drift_rows WHERE is_reference", "drift_cur": "SELECT * FROM drift_rows WHERE NOT is_reference"}


def _drift_with(columns, discrete=None):
    return with_("drift_rows", extra={**_SIDES, **stability(columns, "drift_ref", "drift_cur", discrete=discrete)})


_VERDICT = "CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'investigate' ELSE 'revalidate' END"
_ACTION = "CASE v " + " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in dr.ACTIONS.items()) + " END"
_ALL = ["p", "price", "arrears", "arrears_drifted"]
_PD_SIDES = {
    **{k: v for k, v in MODEL.items() if k not in ("test_long", "test_bins", "logits", "decided", "explained", "points0", "points")},
    "book_long": MODEL["test_long"].replace("SELECT applicant_id, y, feature, value FROM (SELECT applicant_id,", "SELECT applicant_id, y, split, feature, value FROM (SELECT applicant_id, split,")
    .replace("WHERE split = 'test'", "WHERE split <> 'valid'"),
    "test_bins": MODEL["test_bins"].replace("applicant_id, y,", "applicant_id, split, y,").replace("test_long", "book_long"),
    "logits": MODEL["logits"].replace("max(y) AS y,", "max(y) AS y, max(split) AS split,"),
    "decided": MODEL["decided"].replace("SELECT applicant_id, y,", "SELECT applicant_id, split, y,").replace("FROM (SELECT applicant_id, split, y, 1 /", "FROM (SELECT applicant_id, split, y, 1 /"),
    "pd_ref": "SELECT pd AS probability_of_default FROM decided WHERE split = 'train'",
    "pd_cur": "SELECT pd AS probability_of_default FROM decided WHERE split = 'test'",
    **stability(["probability_of_default"], "pd_ref", "pd_cur"),
}
_U = md5u(f"cast(applicant_id AS varchar) || '|{SEED}'") + " / 4294967296::double"
_STRESS = {"revolving_utilisation": 1.45, "utilisation_x_delinquency": 1.45, "debt_ratio": 1.3, "monthly_income": 0.8, "log_monthly_income": 0.95, "disposable_income": 0.75, "income_per_dependent": 0.8}

def _population(name: str, source: str, changes: dict[str, str]) -> dict[str, str]:
    """Raw scores of one population under the fixed model."""
    columns = ", ".join(f"cast({changes.get(f, f)} AS double) AS {f}" for f in BETAS)
    placed = ", ".join(f"CASE WHEN {f} IS NULL THEN -1 ELSE len(list_filter({FIXED_EDGES[f]}::double[], lambda e: e < {f})) END AS {f}" for f in BETAS)
    looked_up = ", ".join(f"coalesce((SELECT woe FROM woe WHERE feature = '{f}' AND bin_index = {name}_bins.{f}), 0) AS w_{f}" for f in BETAS)
    return {
        f"{name}_bins": f"SELECT {placed}, {', '.join(f'{f} AS v_{f}' for f in BETAS)} FROM (SELECT {columns} FROM gold WHERE split = '{source}')",
        name: f"SELECT {OFFSET} - {FACTOR} * {fixed_order_logit('w_')} AS raw_score, {', '.join(f'v_{f} AS {f}' for f in BETAS)} FROM (SELECT {looked_up}, * FROM {name}_bins)",
    }


_SHIFTED = {"age": f"least(greatest(age - 8::double * (0.5::double + {_U}), 18), 100)", **{c: f"{c} * {m}::double" for c, m in _STRESS.items()}}


def _recorded(score: str, reference: str, current: str) -> str:
    """A monitoring record over the table psi, one row per listed shift."""
    return f"""round(t.psi, 6) AS score_psi, v AS score_verdict,
        round((SELECT avg({score}) FROM {reference}), 6) AS reference_mean_score, round((SELECT avg({score}) FROM {current}), 6) AS current_mean_score,
        {_ACTION} AS action, shift_rank, f.feature, round(f.psi, 6) AS psi, {_VERDICT.replace('psi', 'f.psi')} AS verdict
        FROM (SELECT psi, {_VERDICT} AS v FROM psi WHERE feature = '{score}') t,
        (SELECT feature, psi, cast(row_number() OVER (ORDER BY psi DESC, feature) AS int) AS shift_rank FROM psi
         WHERE feature <> '{score}' AND reference_rows >= 10 AND current_rows >= 10) f WHERE shift_rank <= 5"""


def _control(name: str, changes: dict[str, str]) -> str:
    extra = {
        **bins_over("fixed_edges"), **_population("train_scores", "train", {}), **_population("current_scores", "test", changes),
        **stability(["raw_score", *BETAS], "train_scores", "current_scores"),
    }
    return with_("train_long", "fixed_edges", extra=extra) + f"""SELECT '{name}' AS population, {_recorded('raw_score', 'train_scores', 'current_scores')}"""


ORACLES = {
    "h06_control_and_treatment": f"SELECT * FROM ({_control('holdout', {})}) UNION ALL SELECT * FROM ({_control('shifted_population', _SHIFTED)})",
    "f01_auc": _M + "SELECT round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini FROM measured",
    "f02_ks": _M + "SELECT round(ks, 6) AS ks FROM measured",
    "f03_evaluate": _M + """SELECT round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini, round(ks, 6) AS ks, round(brier, 6) AS brier, round(log_loss, 6) AS log_loss,
        round(observed, 6) AS observed_default_rate, round(predicted, 6) AS mean_predicted_rate, n FROM measured""",
    "f04_calibration": with_("scored") + """SELECT cast(greatest(1, ceil((r - 1) * 10 / (n - 1)::double)) AS int) AS decile, count(*) AS count, round(avg(p), 6) AS predicted_rate,
        round(avg(y), 6) AS observed_rate, round(avg(p) - avg(y), 6) AS difference
        FROM (SELECT p, y, row_number() OVER (ORDER BY p, id) AS r, count(*) OVER () AS n FROM scored) GROUP BY 1""",
    "f05_gains": with_("scored", extra={
        "placed": "SELECT y, cast(least((r - 1) * 10 // n + 1, 10) AS int) AS decile FROM (SELECT y, row_number() OVER (ORDER BY p DESC, id) AS r, count(*) OVER () AS n FROM scored)",
        "per_decile": "SELECT decile, count(*) AS count, cast(sum(y) AS bigint) AS bads FROM placed GROUP BY 1",
        "cumulated": "SELECT *, cast(sum(bads) OVER (ORDER BY decile) AS bigint) AS cb, sum(count) OVER (ORDER BY decile) AS cn, sum(bads) OVER () AS tb, sum(count) OVER () AS tn FROM per_decile",
    }) + """SELECT decile, count, bads, round(bads / count::double, 6) AS bad_rate, cb AS cumulative_bads, round(cb / tb::double, 6) AS cumulative_bad_capture,
        round(cn / tn::double, 6) AS cumulative_population, round((cb / tb::double) / (cn / tn::double), 6) AS lift FROM cumulated""",
    "f06_approval": with_("scored") + f"SELECT * REPLACE (round(approval_rate, 6) AS approval_rate, round(bad_rate, 6) AS bad_rate) FROM ({_curve('scored')})",
    "f07_cutoff": with_("scored") + f"""SELECT * REPLACE (round(approval_rate, 6) AS approval_rate, round(bad_rate, 6) AS bad_rate) FROM ({_curve('scored')})
        ORDER BY expected_profit DESC, step LIMIT 1""",
    "f08_business": with_("scored", extra={
        "valid": "SELECT * FROM scored WHERE id % 2 = 0", "test": "SELECT * FROM scored WHERE id % 2 = 1",
        "cut": f"SELECT score_cutoff_probability AS c, approval_rate AS ar FROM ({_curve('valid')}) ORDER BY expected_profit DESC, step LIMIT 1",
        "sums": f"""SELECT max(c) AS c, max(ar) AS ar, min({score_sql('p')}) FILTER (p <= c) AS sc, count(*) AS n, sum(y) AS b, count(*) FILTER (p <= c) AS an,
            coalesce(sum(y) FILTER (p <= c), 0) AS ab FROM test, cut""",
    }) + """SELECT c AS pd_cutoff, round(sc, 6) AS score_cutoff, round(ar, 6) AS approval_rate_on_validation, round(an / n::double, 6) AS approval_rate_on_test,
        round(ab / greatest(an, 1)::double, 6) AS bad_rate_at_cutoff, (an - ab) * 450::double - ab * 2800::double AS expected_profit_at_cutoff,
        (n - b) * 450::double - b * 2800::double AS expected_profit_approve_all,
        ((an - ab) * 450::double - ab * 2800::double) - ((n - b) * 450::double - b * 2800::double) AS profit_uplift FROM sums""",
    "f09_bands": with_("scored") + f"""SELECT cast(position AS int) AS position, band, label, min_score, max_score, applicants,
        round(applicants / (sum(applicants) OVER ())::double, 6) AS population_share, round(rate, 6) AS observed_default_rate
        FROM ({_BAND_ROWS}) JOIN ({_BAND_NAMES}) USING (band)""",
    "f10_monotone": with_("scored") + f"""SELECT bool_and(coalesce(rate <= previous, true)) AS bands_monotonic FROM (
        SELECT rate, lag(rate) OVER (ORDER BY position) AS previous FROM ({_BAND_ROWS}) JOIN ({_BAND_NAMES}) USING (band))""",
    "f11_segments": with_("scored", extra=evaluated("seg")) + """SELECT seg, n, round(2 * auc - 1, 6) AS gini, round(observed, 6) AS observed_default_rate,
        round(predicted, 6) AS mean_predicted_rate FROM measured WHERE n >= 200 AND auc IS NOT NULL""",
    "f12_summary": with_("gold") + f"""SELECT 'rows' AS metric, cast(count(*) AS double) AS value FROM gold UNION ALL SELECT 'features_available', {len(MODEL_FEATURES)}::double
        UNION ALL SELECT 'default_rate', round(avg({TARGET}), 6) FROM gold
        UNION ALL SELECT 'split_' || split, cast(count(*) AS double) FROM gold GROUP BY split""",
    "f13_hist": with_("scored", extra={
        "s": f"SELECT y, {score_sql('p')} AS s FROM scored",
        "ends": "SELECT quantile_cont(s, 0.005) AS lo, quantile_cont(s, 0.995) AS hi FROM s",
        "bins": "SELECT y AS outcome, cast(least(floor((s - lo) / ((hi - lo) / 29)), 28) AS int) AS bin, count(*) AS n FROM s, ends WHERE s BETWEEN lo AND hi GROUP BY 1, 2",
    }) + """SELECT outcome, bin, round(lo + bin * ((hi - lo) / 29), 6) AS bin_start, n,
        round(n / ((sum(n) OVER (PARTITION BY outcome))::double * ((hi - lo) / 29)), 6) AS density FROM bins, ends""",
    "h01_psi": _drift_with(["price", "p"]) + "SELECT * REPLACE (round(psi, 6) AS psi) FROM psi",
    "h02_discrete_psi": _drift_with(["arrears", "arrears_drifted"], True) + "SELECT * REPLACE (round(psi, 6) AS psi) FROM psi",
    "h03_verdict": _drift_with(_ALL) + f"SELECT feature, {_VERDICT} AS verdict FROM psi",
    "h04_drift": _drift_with(_ALL) + f"""SELECT feature, round(psi, 6) AS psi, {_VERDICT} AS verdict, cast(row_number() OVER (ORDER BY psi DESC, feature) AS int) AS shift_rank
        FROM psi WHERE feature <> 'p' AND reference_rows >= 10 AND current_rows >= 10""",
    "h04_drift_summary": _drift_with(_ALL) + f"""SELECT round(psi, 6) AS score_psi, v AS score_verdict, round((SELECT avg(p) FROM drift_ref), 6) AS reference_mean_score,
        round((SELECT avg(p) FROM drift_cur), 6) AS current_mean_score, {_ACTION} AS action FROM (SELECT psi, {_VERDICT} AS v FROM psi WHERE feature = 'p')""",
    "a11_monitoring_row": _drift_with(_ALL) + f"SELECT {_recorded('p', 'drift_ref', 'drift_cur')}",
    "a10_appended_decisions": with_("train_long", "fixed_edges", extra=MODEL)
    + "SELECT applicant_id, round(pd, 6) AS probability_of_default, score, band, '1' AS model_version, 'day ' || (applicant_id % 2) AS batch FROM decided",
    "h05_stress": with_("gold") + f"SELECT applicant_id, least(greatest(age - 8::double * (0.5::double + {_U}), 18), 100) AS age, "
    + ", ".join(f"round({c} * {m}::double, 6) AS {c}" if c.startswith("log") else f"{c} * {m}::double AS {c}" for c, m in _STRESS.items()) + " FROM gold WHERE split = 'test'",
    "h07_train_test_psi": with_("train_long", "fixed_edges", extra=_PD_SIDES) + f"SELECT feature, reference_rows, current_rows, round(psi, 6) AS psi, {_VERDICT} AS verdict FROM psi",
    "h08_expectations": with_("gold") + f"""SELECT 'unique_ids' AS "check", cast(count(*) - count(DISTINCT applicant_id) AS double) AS value, count(*) = count(DISTINCT applicant_id) AS passed FROM gold
        UNION ALL SELECT 'null_targets', cast(count(*) FILTER ({TARGET} IS NULL) AS double), count(*) FILTER ({TARGET} IS NULL) = 0 FROM gold
        UNION ALL SELECT 'splits', cast(count(DISTINCT split) AS double), count(DISTINCT split) = 3 FROM gold
        UNION ALL SELECT 'default_rate', round(avg({TARGET}), 6), avg({TARGET}) > 0.03 AND avg({TARGET}) < 0.12 FROM gold""",
    "h08_published_gold": with_("gold", extra={
        "versions": f"""SELECT 'second' AS name, applicant_id, split, {TARGET} AS y FROM gold UNION ALL SELECT 'first', applicant_id, split, {TARGET} FROM gold
            UNION ALL SELECT 'first', applicant_id, split, {TARGET} FROM gold WHERE applicant_id % 10 = 3 AND {TARGET} = 1""",
        "facts": """SELECT name, count(*) AS n, count(DISTINCT applicant_id) AS ids, count(*) FILTER (y IS NULL) AS nulls, count(DISTINCT split) AS splits, avg(y) AS rate
            FROM versions GROUP BY 1""",
        "checks": """SELECT name, 'unique_ids' AS "check", cast(n - ids AS double) AS value, n = ids AS passed FROM facts
            UNION ALL SELECT name, 'null_targets', cast(nulls AS double), nulls = 0 FROM facts
            UNION ALL SELECT name, 'splits', cast(splits AS double), splits = 3 FROM facts
            UNION ALL SELECT name, 'default_rate', round(rate, 6), rate > 0.03 AND rate < 0.30 FROM facts"""})
    + """SELECT name, "check", value, passed, bool_and(passed) OVER (PARTITION BY name) AS published, (SELECT n FROM facts WHERE name = 'second') AS rows_seen,
        (SELECT ids FROM facts WHERE name = 'second') AS ids_seen FROM checks""",
    "a09_bucketed_decisions": with_("train_long", "fixed_edges", extra={**MODEL, "test_long": MODEL["test_long"].replace(" WHERE split = 'test'", "")})
    + f"SELECT split, band, count(*) AS n, cast(sum({TARGET}) AS bigint) AS bads FROM decided JOIN gold USING (applicant_id) GROUP BY 1, 2",
    "h10_gated_decisions": with_("train_long", "fixed_edges", extra=MODEL) + "SELECT applicant_id, score, band, '1' AS model_version, 'usual' AS batch FROM decided",
    "h09_gate": with_("scored", "drift_rows", extra={**evaluated(None), **_SIDES, **stability(["p"], "drift_ref", "drift_cur"),
        "mono": f"""SELECT bool_and(coalesce(rate <= previous, true)) AS ok FROM (SELECT rate, lag(rate) OVER (ORDER BY position) AS previous FROM ({_BAND_ROWS}) JOIN ({_BAND_NAMES}) USING (band))"""})
    + f"""SELECT 'gini' AS gate, round(2 * auc - 1, 6) AS value, 0.65::double AS threshold, 2 * auc - 1 >= 0.65 AS passed FROM measured
        UNION ALL SELECT 'ks', round(ks, 6), 0.5::double, ks >= 0.5 FROM measured
        UNION ALL SELECT 'brier', round(brier, 6), 0.06::double, brier <= 0.06 FROM measured
        UNION ALL SELECT 'bands_monotonic', cast(cast(ok AS int) AS double), 1::double, ok FROM mono
        UNION ALL SELECT 'population_stable', round(psi, 6), NULL, {_VERDICT} = 'stable' FROM psi""",
}
