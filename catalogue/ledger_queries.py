"""Transaction ledger: text, behaviour, holdout, affordability."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.ctes import md5u, with_
from catalogue.inputs import r6
from gradus.operators import ledger as lg
from gradus.operators import text as tx
from gradus.sources.retail import ledger
from gradus.sources.tables import ledger_sample, materialise

SEED = 7


def _categories(rows) -> int:
    return rows.agg(F.count_distinct("true_category")).first()[0]


def a13_ledger_sample(spark, sf):
    return ledger_sample(ledger(spark, sf).select("applicant_id", "day", "transaction_id", "description", "amount", "true_category"))


def i01_stem(spark, sf):
    return lg.with_stem(ledger(spark, sf)).select("transaction_id", "merchant_stem")


def i03_i05_behaviour(spark, sf):
    rows = lg.behavioural_features(ledger(spark, sf)).select("transaction_id", *lg.BEHAVIOUR)
    return rows.withColumns(r6("abs_amount_log", "merchant_amount_cv", "share_of_month_outflow"))


def i06_holdout(spark, sf):
    return lg.holdout_merchants(ledger(spark, sf), SEED)


def _split(spark, sf, behaviour=False):
    rows = ledger(spark, sf)
    held = materialise(lg.holdout_merchants(rows, SEED))
    rows = materialise(lg.behavioural_features(rows)) if behaviour else rows  # once for both sides
    return lg.split_by_merchant(rows, held)


def i06_test_rows(spark, sf):
    return _split(spark, sf)[1].select("transaction_id")


def i10_baselines(spark, sf):
    return lg.baselines(_split(spark, sf)[1], _categories(ledger(spark, sf))).withColumns(r6("majority_class_baseline", "uniform_baseline"))


def i07_char_ngrams(spark, sf):
    rows = ledger(spark, sf)
    idf = materialise(tx.fit_idf(rows))
    return tx.tfidf(tx.description_counts(rows), idf).withColumns(r6("weight"))


def i07_idf(spark, sf):
    return tx.fit_idf(ledger(spark, sf)).withColumns(r6("idf"))


def i08_text_clf(spark, sf):
    train, test = _split(spark, sf)
    return tx.accuracy(tx.fit_categoriser(train, behaviour=False).transform(test))


def _hybrid(spark, sf):
    train, test = _split(spark, sf, behaviour=True)
    train, test = materialise(train), materialise(test)
    return tx.fit_categoriser(train, behaviour=True), train, test


def i09_hybrid_clf(spark, sf):
    model, _, test = _hybrid(spark, sf)
    return tx.accuracy(model.transform(test))


def i11_class_report(spark, sf):
    model, _, test = _hybrid(spark, sf)
    return tx.class_report(model.transform(test))


def i12_categorise(spark, sf):
    model, train, test = _hybrid(spark, sf)
    return tx.accuracy(model.transform(train.unionByName(test)))


def _guessed(spark, sf):
    """A stand-in prediction, so that the report itself can be checked: every fifth row wrong."""
    rows = ledger(spark, sf)
    return rows.withColumn("category", F.when(F.col("transaction_id") % 5 == 0, "fees").otherwise(F.col("true_category")))


def i11_report_of_known_guess(spark, sf):
    return tx.class_report(_guessed(spark, sf)).withColumns(r6("precision", "recall", "f1"))


def i12_agreement_of_known_guess(spark, sf):
    return tx.accuracy(_guessed(spark, sf)).withColumns(r6("accuracy"))


def i13_i18_cashflow(spark, sf):
    out = lg.cashflow_features(ledger(spark, sf, with_balance=True), 6, "true_category")
    return out.select("applicant_id", *[F.round(c, 6).alias(c) if c.startswith("ob_") and c != "ob_income_payment_count" else F.col(c) for c in out.columns[1:]])


def i19_summary(spark, sf):
    rows = ledger(spark, sf)
    held = materialise(lg.holdout_merchants(rows, SEED))
    base = lg.baselines(lg.split_by_merchant(rows, held)[1], _categories(rows)).drop("test_rows")
    derived = [c for c in lg.cashflow_features(ledger(spark, sf, with_balance=True), 6, "true_category").columns if c.startswith("ob_")]
    agreement = {"full_ledger_agreement": tx.accuracy(_guessed(spark, sf))}
    return lg.track_summary(rows, held, [base.unpivot([], base.columns, "metric", "value")], agreement, derived).withColumns(r6("value"))


def i20_invariants(spark, sf):
    return lg.ledger_expectations(ledger(spark, sf, with_balance=True))


QUERIES = {f.__name__: f for f in (
    a13_ledger_sample, i01_stem, i03_i05_behaviour, i06_holdout, i06_test_rows, i07_char_ngrams, i07_idf, i08_text_clf, i09_hybrid_clf, i10_baselines,
    i11_class_report, i11_report_of_known_guess, i12_categorise, i12_agreement_of_known_guess, i13_i18_cashflow, i19_summary, i20_invariants,
)}

# --- SQL ----------------------------------------------------------------------------------
_HELD = {
    "stems": "SELECT true_category, merchant_stem, " + md5u(f"merchant_stem || '|{SEED}'", 15) + " AS key FROM stemmed GROUP BY 1, 2",
    "held": """SELECT true_category, merchant_stem FROM (SELECT *, row_number() OVER (PARTITION BY true_category ORDER BY key, merchant_stem) AS r,
        count(*) OVER (PARTITION BY true_category) AS merchants FROM stems) WHERE merchants > 2 AND r <= greatest(1, merchants // 4)""",
    "test_rows": "SELECT * FROM stemmed WHERE merchant_stem IN (SELECT merchant_stem FROM held)",
}
_H = with_("stemmed", extra=_HELD)
_TEXT = {
    "descriptions": "SELECT description, count(*) AS documents FROM ledger GROUP BY 1",
    "words": "SELECT description, documents, ' ' || unnest(list_filter(regexp_split_to_array(lower(description), '\\s+'), lambda w: w <> '')) || ' ' AS word FROM descriptions",
    "sized": "SELECT *, unnest(range(2, least(5, length(word)) + 1)) AS n FROM words",
    "placed_grams": "SELECT *, unnest(range(1, length(word) - n + 2)) AS i FROM sized",
    "terms": "SELECT description, documents, substr(word, i, n) AS gram, count(*) AS tf FROM placed_grams GROUP BY 1, 2, 3",
    "idf": """SELECT gram, cast(sum(documents) AS bigint) AS df, ln((1 + (SELECT sum(documents) FROM descriptions)) / (1 + sum(documents))::double) + 1 AS idf
        FROM terms GROUP BY 1 HAVING sum(documents) >= 2""",
    "weighted": "SELECT description, gram, (1 + ln(tf)) * idf AS w FROM terms JOIN idf USING (gram)",
}
_GUESSED = {"guessed": "SELECT *, CASE WHEN transaction_id % 5 = 0 THEN 'fees' ELSE true_category END AS category FROM ledger"}
# Derived columns in published order.
_DERIVED = [
    "ob_income_monthly_median", "ob_income_payment_count", "ob_income_volatility", "ob_income_is_regular", "ob_essential_spend_monthly", "ob_essential_spend_ratio",
    "ob_discretionary_spend_monthly", "ob_discretionary_spend_ratio", "ob_debt_repayment_monthly", "ob_cash_monthly", "ob_fees_monthly", "ob_fee_events",
    "ob_min_balance", "ob_mean_balance", "ob_days_in_overdraft", "ob_surplus_after_essentials", "ob_essential_cover_ratio", "ob_spend_volatility",
]
_OUT = "CASE WHEN amount < 0 THEN -amount ELSE 0 END"
_FLOW = {
    "flow": f"SELECT *, {_OUT} AS outflow, least(day // 30, 5) AS month FROM banked",
    "months": "SELECT DISTINCT month FROM flow",
    "monthly": """SELECT applicant_id, m.month, coalesce(sum(outflow), 0) AS x FROM (SELECT DISTINCT applicant_id FROM flow) a CROSS JOIN months m
        LEFT JOIN flow USING (applicant_id, month) GROUP BY 1, 2""",
    "spread": "SELECT applicant_id, stddev_samp(x) / nullif(avg(x), 0) AS volatility FROM monthly GROUP BY 1",
    "sums": """SELECT applicant_id, median(amount) FILTER (true_category = 'income') AS inc_med, count(*) FILTER (true_category = 'income') AS inc_n,
        stddev_samp(amount) FILTER (true_category = 'income') / nullif(avg(amount) FILTER (true_category = 'income'), 0) AS inc_cv,
        sum(outflow) FILTER (true_category IN ('groceries', 'housing', 'transport', 'utilities')) AS ess,
        sum(outflow) FILTER (true_category IN ('eating_out', 'shopping', 'subscriptions')) AS dis, sum(outflow) AS total,
        coalesce(sum(outflow) FILTER (true_category = 'debt_repayment'), 0) AS debt, coalesce(sum(outflow) FILTER (true_category = 'cash'), 0) AS cash,
        coalesce(sum(outflow) FILTER (true_category = 'fees'), 0) AS fees, count(*) FILTER (true_category = 'fees') AS fee_n,
        min(balance_after) AS bmin, avg(balance_after) AS bavg, count(DISTINCT CASE WHEN balance_after < 0 THEN day END) AS od FROM flow GROUP BY 1""",
}

ORACLES = {
    "a13_ledger_sample": with_("ledger") + "SELECT applicant_id, day, transaction_id, description, amount, true_category FROM ledger ORDER BY applicant_id, day, transaction_id LIMIT 500",
    "i01_stem": with_("stemmed") + "SELECT transaction_id, merchant_stem FROM stemmed",
    "i03_i05_behaviour": with_("stemmed", extra={
        "m": "SELECT applicant_id, merchant_stem, count(*) AS f, coalesce(coalesce(stddev_samp(amount), 0) / nullif(abs(avg(amount)), 0), 0) AS cv FROM stemmed GROUP BY 1, 2",
        "o": f"SELECT applicant_id, day // 30 AS mo, sum({_OUT}) AS total FROM stemmed GROUP BY 1, 2",
    }) + """SELECT transaction_id, round(ln(1 + abs(amount)), 6) AS abs_amount_log, cast(amount > 0 AS double) AS is_credit, day % 30 AS day_of_month, f AS merchant_frequency,
        round(cv, 6) AS merchant_amount_cv, cast(f BETWEEN 4 AND 8 AND cv < 0.25 AS double) AS merchant_is_monthly,
        round(coalesce(abs(amount) / nullif(total, 0), 0), 6) AS share_of_month_outflow
        FROM stemmed s JOIN m USING (applicant_id, merchant_stem) JOIN o ON o.applicant_id = s.applicant_id AND o.mo = s.day // 30""",
    "i06_holdout": _H + "SELECT true_category, merchant_stem FROM held",
    "i06_test_rows": _H + "SELECT transaction_id FROM test_rows",
    "i07_char_ngrams": with_("ledger", extra=_TEXT) + "SELECT description, gram, round(w / sqrt(sum(w * w) OVER (PARTITION BY description)), 6) AS weight FROM weighted",
    "i07_idf": with_("ledger", extra=_TEXT) + "SELECT gram, df, round(idf, 6) AS idf FROM idf",
    "i10_baselines": _H + f"""SELECT round(max(n) / sum(n)::double, 6) AS majority_class_baseline, round(1 / (SELECT count(DISTINCT true_category) FROM ledger)::double, 6) AS uniform_baseline, cast(sum(n) AS bigint) AS test_rows
        FROM (SELECT count(*) AS n FROM test_rows GROUP BY true_category)""",
    "i11_report_of_known_guess": with_("ledger", extra={**_GUESSED,
        "labels": "SELECT true_category AS label FROM guessed UNION SELECT category FROM guessed",
        "tallied": """SELECT label, (SELECT count(*) FROM guessed WHERE true_category = label) AS support, (SELECT count(*) FROM guessed WHERE category = label) AS guessed,
            (SELECT count(*) FROM guessed WHERE category = label AND true_category = label) AS hit FROM labels""",
        "pr": "SELECT label, support, coalesce(hit / nullif(guessed, 0)::double, 0) AS p, coalesce(hit / nullif(support, 0)::double, 0) AS r FROM tallied"})
    + "SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1, support FROM pr",
    "i12_agreement_of_known_guess": with_("ledger", extra=_GUESSED) + "SELECT round(avg(cast(category = true_category AS int)), 6) AS accuracy, count(*) AS n FROM guessed",
    "i13_i18_cashflow": with_("banked", extra=_FLOW) + """SELECT applicant_id, round(inc_med, 6) AS ob_income_monthly_median, nullif(inc_n, 0) AS ob_income_payment_count,
        round(inc_cv, 6) AS ob_income_volatility, coalesce(cast(inc_cv < 0.15 AS double), 0) AS ob_income_is_regular, round(ess / 6, 6) AS ob_essential_spend_monthly,
        round(coalesce(ess / nullif(total, 0), 0), 6) AS ob_essential_spend_ratio, round(dis / 6, 6) AS ob_discretionary_spend_monthly,
        round(coalesce(dis / nullif(total, 0), 0), 6) AS ob_discretionary_spend_ratio, round(debt / 6, 6) AS ob_debt_repayment_monthly, round(cash / 6, 6) AS ob_cash_monthly,
        round(fees / 6, 6) AS ob_fees_monthly, cast(fee_n AS double) AS ob_fee_events, round(bmin, 6) AS ob_min_balance, round(bavg, 6) AS ob_mean_balance,
        cast(od AS double) AS ob_days_in_overdraft, round(coalesce(inc_med, 0) - coalesce(ess / 6, 0), 6) AS ob_surplus_after_essentials,
        round(inc_med / nullif(ess / 6, 0), 6) AS ob_essential_cover_ratio, round(volatility, 6) AS ob_spend_volatility FROM sums JOIN spread USING (applicant_id)""",
    "i19_summary": with_("stemmed", extra={**_HELD, **_GUESSED}) + f"""SELECT 'applicants' AS metric, cast(count(DISTINCT applicant_id) AS double) AS value FROM stemmed UNION ALL SELECT 'transactions', cast(count(*) AS double) FROM stemmed
        UNION ALL SELECT 'n_categories', cast(count(DISTINCT true_category) AS double) FROM stemmed UNION ALL SELECT 'held_out_merchants', cast(count(*) AS double) FROM held
        UNION ALL SELECT 'majority_class_baseline', round(max(n) / sum(n)::double, 6) FROM (SELECT count(*) AS n FROM test_rows GROUP BY true_category)
        UNION ALL SELECT 'uniform_baseline', round(1 / (SELECT count(DISTINCT true_category) FROM ledger)::double, 6)
        UNION ALL SELECT 'months_of_history', cast(max(day) // 30 + 1 AS double) FROM stemmed
        UNION ALL SELECT 'full_ledger_agreement', round(avg(cast(category = true_category AS int)), 6) FROM guessed
        UNION ALL SELECT 'feature ' || name, cast(place AS double) FROM (SELECT unnest({_DERIVED}) AS name, unnest(range(1, {len(_DERIVED) + 1})) AS place)""",
    "i20_invariants": with_("banked", extra={
        "a": """SELECT applicant_id, count(*) FILTER (true_category = 'income' AND amount <= 0) AS i, count(*) FILTER (true_category <> 'income' AND amount >= 0) AS s,
            count(*) FILTER (true_category = 'income') AS n, count(*) FILTER (true_category IN ('groceries', 'housing', 'transport', 'utilities')) AS e,
            min(balance_after) AS lo, count(*) FILTER (balance_after < 0) AS od FROM banked GROUP BY 1""",
        "v": """SELECT 'income_is_positive' AS "check", cast(sum(i) AS bigint) AS violations FROM a UNION ALL SELECT 'spend_is_negative', cast(sum(s) AS bigint) FROM a
            UNION ALL SELECT 'every_applicant_has_income', count(*) FILTER (n = 0) FROM a UNION ALL SELECT 'every_applicant_has_essentials', count(*) FILTER (e = 0) FROM a
            UNION ALL SELECT 'overdraft_matches_lowest_balance', count(*) FILTER ((od > 0) <> (lo < 0)) FROM a"""})
    + 'SELECT "check", violations, violations = 0 AS passed FROM v',
}
