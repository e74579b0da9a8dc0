"""Sources, silver and gold."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.ctes import KEY, NUMERIC, with_
from catalogue.fixed import EXPECTED_ROWS, SEED
from catalogue.inputs import gold, r6, silver, staged_silver
from gradus.operators import features as feat
from gradus.operators import quality as q
from gradus.sources.retail import applications_raw
from gradus.sources.tables import RAW_COLUMN_NAMES, land_raw, landed_check, materialise

ID, TARGET = "applicant_id", feat.TARGET


def a02_bronze_land(spark, sf):
    original = {v: k for k, v in RAW_COLUMN_NAMES.items()}
    raw = applications_raw(spark, sf).withColumnsRenamed({ID: "_c0", **original})
    return land_raw(raw, source_file="orders").drop("ingested_at")


def a07_gold_by_split(spark, sf):
    g = gold(spark, sf)
    return g.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(TARGET).cast("bigint")).alias("bads"), F.min(ID).alias("first_id"), F.max(ID).alias("last_id")
    )


def a14_landed_check(spark, sf):
    return landed_check(applications_raw(spark, sf), [TARGET, "monthly_income"], EXPECTED_ROWS)


def b01_unparseable(spark, sf):
    return q.cast_audit(applications_raw(spark, sf))


def b02_dedupe(spark, sf):
    return _deduped(spark, sf)


def _deduped(spark, sf):
    return q.drop_exact_duplicates(q.cast_columns(applications_raw(spark, sf)))


def b03_sentinel(spark, sf):
    return q.null_sentinels(_deduped(spark, sf), q.COUNTERS, q.SENTINELS, "flag_delinquency_sentinel").select(ID, *q.COUNTERS, "flag_delinquency_sentinel")


def b04_age(spark, sf):
    return q.null_out_of_range(_deduped(spark, sf), "age", *q.AGE_RANGE).select(ID, "age")


def b05_unit_switch(spark, sf):
    return q.split_unit_switch(
        _deduped(spark, sf), "debt_ratio", "monthly_income", q.UNIT_SWITCH_ABOVE, "monthly_debt_amount", "flag_debt_ratio_is_amount"
    ).select(ID, "debt_ratio", "monthly_debt_amount", "flag_debt_ratio_is_amount")


def b06_missing(spark, sf):
    return q.flag_missing(_deduped(spark, sf), q.MISSING_FLAGS).select(ID, "flag_monthly_income_missing", "flag_dependents_missing")


def b07_winsorise(spark, sf):
    return silver(spark, sf).select(ID, *q.WINSOR_BOUNDS)


def b08_dq_report(spark, sf):
    return q.build_silver(applications_raw(spark, sf))[1]


def b09_silver(spark, sf):
    return silver(spark, sf)


# --- gold ---------------------------------------------------------------------------------
def c01_c04_credit_mix(spark, sf):
    return feat.credit_mix(silver(spark, sf)).select(
        ID, "total_delinquencies", "worst_delinquency_severity", "delinquencies_per_credit_line", "unsecured_lines", "real_estate_share_of_lines"
    )


def c05_c06_band_income(spark, sf):
    s = staged_silver(spark, sf)
    return feat.impute(s, feat.fit_constants(s)).select(ID, "age_band", "monthly_income")


def c07_global_fill(spark, sf):
    s = staged_silver(spark, sf)
    return feat.impute(s, feat.fit_constants(s)).select(ID, "age", "debt_ratio", "dependents", "monthly_debt_amount")


def c08_affordability(spark, sf):
    return gold(spark, sf).select(
        ID, "monthly_debt_service", "disposable_income", "income_per_dependent", "log_monthly_income", "utilisation_x_delinquency"
    ).withColumns(r6("log_monthly_income"))


def c09_split_md5(spark, sf):
    return feat.hash_split(silver(spark, sf).select(ID), ID, SEED, method="md5")


def c09_split_murmur3(spark, sf):
    return feat.hash_split(silver(spark, sf).select(ID), ID, SEED).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def c10_constants(spark, sf):
    return feat.fit_constants(staged_silver(spark, sf)).to_frame(spark)


def c11_gold(spark, sf):
    return gold(spark, sf).withColumns(r6("log_monthly_income"))


def _applications_only(s):
    """What an application form holds: the raw inputs, none of the flags."""
    return s.select(ID, *feat.RAW_INPUTS)


def c12_replay(spark, sf):
    s = staged_silver(spark, sf)
    replayed = feat.derive_features(_applications_only(s), feat.fit_constants(s))
    return replayed.select(
        ID, "age_band", "monthly_income", "age", "debt_ratio", "monthly_debt_amount", "monthly_debt_service", "utilisation_x_delinquency", *feat.CLEAN_FLAGS
    )


def c13_parity(spark, sf):
    """Written gold next to a replay from written constants; two slips in gold have to be found."""
    s = staged_silver(spark, sf)
    fitted = feat.fit_constants(s)
    constants = feat.ImputationConstants.from_frame(materialise(fitted.to_frame(spark)))
    slips = {
        "age": F.when(F.col(ID) % 1000 == 7, F.col("age") + 1).otherwise(F.col("age")),
        "debt_ratio": F.when(F.col(ID) % 1000 != 65, F.col("debt_ratio")),
    }
    stored = materialise(feat.build_gold(s, fitted, SEED, "md5").withColumns(slips))
    replayed = feat.derive_features(_applications_only(s), constants)
    # What the form cannot know: the flags, and the amount that the silver layer set apart.
    return feat.parity(stored, replayed, ID, feat.MODEL_FEATURES, exempt=(*feat.CLEAN_FLAGS, "monthly_debt_amount"))


QUERIES = {f.__name__: f for f in (
    a02_bronze_land, a07_gold_by_split, a14_landed_check, b01_unparseable, b02_dedupe, b03_sentinel, b04_age, b05_unit_switch, b06_missing,
    b07_winsorise, b08_dq_report, b09_silver, c01_c04_credit_mix, c05_c06_band_income, c07_global_fill, c08_affordability, c09_split_md5,
    c09_split_murmur3, c10_constants, c11_gold, c12_replay, c13_parity,
)}

_RAW = ["applicant_id", TARGET, *NUMERIC]
_UNPARSED = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (trim({c}) <> '' AND try_cast(trim({c}) AS double) IS NULL) AS records FROM raw" for c in _RAW
)
_GOLD_COLUMNS = ["applicant_id", TARGET, "split", "age_band", *feat.MODEL_FEATURES]
_SILVER_COLUMNS = [
    "applicant_id", TARGET, *NUMERIC, "flag_delinquency_sentinel", "flag_debt_ratio_is_amount", "monthly_debt_amount",
    "flag_monthly_income_missing", "flag_dependents_missing",
]
_SLIPS = {"age": "CASE WHEN applicant_id % 1000 = 7 THEN age + 1 ELSE age END", "debt_ratio": "CASE WHEN applicant_id % 1000 <> 65 THEN debt_ratio END"}
_PARITY = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, count(*) AS compared, count(*) FILTER ((a IS NULL) <> (b IS NULL)) AS null_mismatches,
        coalesce(max(abs(a - b)), 0)::double AS max_abs_difference,
        count(*) FILTER ((a IS NULL) <> (b IS NULL)) = 0 AND coalesce(max(abs(a - b)), 0) <= 1e-6 AS within_tolerance
        FROM (SELECT cast({_SLIPS.get(f, f)} AS double) AS a, cast({f} AS double) AS b FROM gold)"""
    for f in feat.MODEL_FEATURES if f not in (*feat.CLEAN_FLAGS, "monthly_debt_amount")
)

_M32 = "4294967295::ubigint"


def _times(x: str, by: int) -> str:
    return f"((({x}) * {by}::ubigint) & {_M32})"


def _turned(x: str, by: int) -> str:
    """Rotated left within 32 bits."""
    return f"(((({x}) << {by}) & {_M32}) | (({x}) >> {32 - by}))"


# 32-bit Murmur3 of ASCII text: blocks of four bytes, then single bytes as blocks of their own; seed and constants are the algorithm's.
_MURMUR = {
    "texts": f"SELECT applicant_id, cast(applicant_id AS varchar) || '|{SEED}' AS t FROM gold",
    "blocks": """SELECT applicant_id, length(t)::ubigint AS n, list_concat(
        list_transform(range(0, length(t) // 4), lambda i: list_sum(list_transform(range(4), lambda j: ascii(substr(t, 4 * i + j + 1, 1)) * (256 ** j)))::ubigint),
        list_transform(range(length(t) // 4 * 4, length(t)), lambda i: ascii(substr(t, i + 1, 1))::ubigint)) AS ks FROM texts""",
    "multiplied": f"SELECT applicant_id, n, list_transform(ks, lambda k: {_times('k', 0xCC9E2D51)}) AS ks FROM blocks",
    "scrambled": f"SELECT applicant_id, n, list_transform(ks, lambda k: {_times(_turned('k', 15), 0x1B873593)}) AS ks FROM multiplied",
    "mixed_in": f"""SELECT applicant_id, n, list_reduce(list_concat([42::ubigint], ks),
        lambda h, k: (({_turned('xor(h, k)', 13)}) * 5::ubigint + {0xE6546B64}::ubigint) & {_M32}) AS h FROM scrambled""",
    "ended1": "SELECT applicant_id, xor(h, n) AS h FROM mixed_in",
    "ended2": f"SELECT applicant_id, {_times('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM ended1",
    "ended3": f"SELECT applicant_id, {_times('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM ended2",
    "ended": "SELECT applicant_id, xor(h, h >> 16)::bigint AS h FROM ended3",
    "dealt": "SELECT ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 1000 + 1000) % 1000 AS bucket FROM ended",
}

ORACLES = {
    "c09_split_murmur3": with_("gold", extra=_MURMUR) + """SELECT CASE WHEN bucket < 600 THEN 'train' WHEN bucket < 800 THEN 'valid' ELSE 'test' END AS split, count(*) AS n
        FROM dealt GROUP BY 1""",
    "a02_bronze_land": with_("raw") + "SELECT *, 'orders' AS source_file FROM raw",
    "a07_gold_by_split": with_("gold") + f"SELECT split, count(*) AS n, cast(sum({TARGET}) AS bigint) AS bads, min(applicant_id) AS first_id, max(applicant_id) AS last_id FROM gold GROUP BY 1",
    "a14_landed_check": with_("raw") + f"""
        SELECT 'header_present' AS "check", cast(NULL AS bigint) AS value, cast(NULL AS bigint) AS expected, true AS passed
        UNION ALL SELECT 'row_count', count(*), cast({EXPECTED_ROWS} AS bigint), count(*) = {EXPECTED_ROWS} FROM raw""",
    "b01_unparseable": with_("raw") + f"SELECT * FROM ({_UNPARSED}) WHERE records > 0",
    "b02_dedupe": with_("deduped") + f"SELECT applicant_id, {KEY} FROM deduped",
    "b03_sentinel": with_("sentinel_free") + "SELECT applicant_id, times_30_59_dpd, times_60_89_dpd, times_90_dpd, flag_delinquency_sentinel FROM sentinel_free",
    "b04_age": with_("sentinel_free") + "SELECT applicant_id, age FROM sentinel_free",
    "b05_unit_switch": with_("unit_split") + "SELECT applicant_id, debt_ratio, monthly_debt_amount, flag_debt_ratio_is_amount FROM unit_split",
    "b06_missing": with_("unit_split") + "SELECT applicant_id, flag_monthly_income_missing, flag_dependents_missing FROM unit_split",
    "b07_winsorise": with_("silver") + "SELECT applicant_id, revolving_utilisation, debt_ratio, monthly_income, dependents FROM silver",
    "b08_dq_report": with_("silver") + f"""
        SELECT 'rows_in' AS rule, cast(NULL AS varchar) AS "column", count(*) AS records FROM raw
        UNION ALL SELECT 'exact_duplicates_removed', NULL, (SELECT count(*) FROM raw) - count(*) FROM deduped
        UNION ALL SELECT 'delinquency_sentinel_rows', NULL, count(*) FILTER (flag_delinquency_sentinel = 1) FROM silver
        UNION ALL SELECT 'invalid_age_rows', NULL, count(*) FILTER (hit_age = 1) FROM silver
        UNION ALL SELECT 'debt_ratio_unit_ambiguous_rows', NULL, count(*) FILTER (flag_debt_ratio_is_amount = 1) FROM silver
        UNION ALL SELECT 'missing_rows', 'monthly_income', count(*) FILTER (flag_monthly_income_missing = 1) FROM silver
        UNION ALL SELECT 'missing_rows', 'dependents', count(*) FILTER (flag_dependents_missing = 1) FROM silver
        UNION ALL SELECT 'values_winsorised', 'revolving_utilisation', count(*) FILTER (hit_revolving_utilisation = 1) FROM silver
        UNION ALL SELECT 'values_winsorised', 'debt_ratio', count(*) FILTER (hit_debt_ratio = 1) FROM silver
        UNION ALL SELECT 'values_winsorised', 'monthly_income', count(*) FILTER (hit_monthly_income = 1) FROM silver
        UNION ALL SELECT 'values_winsorised', 'dependents', count(*) FILTER (hit_dependents = 1) FROM silver
        UNION ALL SELECT 'rows_out', NULL, count(*) FROM silver
        UNION ALL SELECT 'unparseable_values_nulled', "column", records FROM ({_UNPARSED}) WHERE records > 0""",
    "b09_silver": with_("silver") + f"SELECT {', '.join(_SILVER_COLUMNS)} FROM silver",
    "c01_c04_credit_mix": with_("gold") + """SELECT applicant_id, total_delinquencies, worst_delinquency_severity, delinquencies_per_credit_line,
        unsecured_lines, real_estate_share_of_lines FROM gold""",
    "c05_c06_band_income": with_("imputed") + "SELECT applicant_id, age_band, monthly_income FROM imputed",
    "c07_global_fill": with_("imputed") + "SELECT applicant_id, age, debt_ratio, dependents, monthly_debt_amount FROM imputed",
    "c08_affordability": with_("gold") + """SELECT applicant_id, monthly_debt_service, disposable_income, income_per_dependent,
        round(log_monthly_income, 6) AS log_monthly_income, utilisation_x_delinquency FROM gold""",
    "c09_split_md5": with_("gold") + "SELECT applicant_id, split FROM gold",
    "c10_constants": with_("band_medians") + """
        SELECT 'monthly_income_by_age_band' AS "constant", age_band, band_income AS value FROM band_medians
        UNION ALL SELECT 'monthly_income_global_median', NULL, income FROM medians
        UNION ALL SELECT 'age_median', NULL, age FROM medians
        UNION ALL SELECT 'debt_ratio_median', NULL, debt_ratio FROM medians
        UNION ALL SELECT 'dependents_fill', NULL, cast(0 AS double)
        UNION ALL SELECT 'monthly_debt_amount_fill', NULL, cast(0 AS double)""",
    "c11_gold": with_("gold") + "SELECT * REPLACE (round(log_monthly_income, 6) AS log_monthly_income) FROM (SELECT " + ", ".join(_GOLD_COLUMNS) + " FROM gold)",
    "c12_replay": with_("gold") + """
        SELECT applicant_id, age_band, monthly_income, age, debt_ratio, cast(0 AS double) AS monthly_debt_amount, monthly_debt_service,
          utilisation_x_delinquency, 0 AS flag_delinquency_sentinel, 0 AS flag_monthly_income_missing, 0 AS flag_debt_ratio_is_amount FROM gold""",
    "c13_parity": with_("gold") + _PARITY,
}
