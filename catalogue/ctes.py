"""Named SQL fragments; ``with_(...)`` puts them together for one statement."""

from __future__ import annotations

from catalogue.fixed import FIXED_EDGES, SEED
from gradus.operators.features import MODEL_FEATURES


def md5u(text: str, digits: int = 8) -> str:
    return f"cast('0x' || substr(md5({text}), 1, {digits}) as bigint)"


CTES: dict[str, tuple[list[str], str]] = {}


def _add(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql)


def with_(*names: str, extra: dict[str, str] | None = None) -> str:
    """WITH clause of the named fragments, what they need, and ``extra`` ones after them."""
    done: list[str] = []

    def visit(n: str) -> None:
        if n in done:
            return
        for need in CTES[n][0]:
            visit(need)
        done.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]})" for n in done] + [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"


_add("per_order", [], """
  SELECT l_orderkey AS k, count(*) AS n,
    cast(sum(cast(round(l_discount * 100) AS int)) AS bigint) AS disc, cast(sum(cast(round(l_tax * 100) AS int)) AS bigint) AS tax,
    count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS d30,
    count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity > 35) AS d60,
    count(*) FILTER (l_returnflag = 'A' AND l_quantity > 45) AS d90
  FROM lineitem GROUP BY 1""")
_add("orders_base", ["per_order"], """
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice, coalesce(n, 0) AS n, coalesce(disc, 0) AS disc, coalesce(tax, 0) AS tax,
    coalesce(d30, 0) AS d30, coalesce(d60, 0) AS d60, coalesce(d90, 0) AS d90
  FROM orders LEFT JOIN per_order ON o_orderkey = k""")
_add("raw", ["orders_base"], f"""
  SELECT cast(unnest(CASE WHEN k % 250 = 0 THEN [k, k + 1000000000] ELSE [k] END) AS varchar) AS applicant_id,
    cast(CASE WHEN {md5u('cast(k AS varchar)')} % 1000
      < 20 + CASE WHEN n = 0 THEN 0 ELSE cast(15 AS double) * disc / n END + 60 * d30 + 80 * d60 + 120 * d90 THEN 1 ELSE 0 END AS varchar) AS target_default_90dpd_2yr,
    cast(CASE WHEN k % 400 = 7 THEN cast(50708 AS double) WHEN n = 0 THEN cast(0 AS double) ELSE cast(disc AS double) / (10 * n) END AS varchar) AS revolving_utilisation,
    cast(CASE WHEN k % 3000 = 3 THEN 0 ELSE 18 + c % 70 END AS varchar) AS age,
    cast(CASE WHEN k % 500 = 11 THEN 98 ELSE d30 END AS varchar) AS times_30_59_dpd,
    cast(CASE WHEN k % 5 = 2 AND k % 4 <> 0 THEN cast(150 + k % 5000 AS double) ELSE tax / cast(8 AS double) END AS varchar) AS debt_ratio,
    CASE WHEN k % 5 = 2 THEN 'NA' ELSE cast(o_totalprice / cast(50 AS double) AS varchar) END AS monthly_income,
    cast(n + k % 10 AS varchar) AS open_credit_lines,
    cast(CASE WHEN k % 500 = 11 THEN 98 ELSE d90 END AS varchar) AS times_90_dpd,
    cast(k % 3 AS varchar) AS real_estate_lines,
    cast(CASE WHEN k % 500 = 11 THEN 98 ELSE d60 END AS varchar) AS times_60_89_dpd,
    CASE WHEN k % 40 = 9 THEN 'NA' ELSE cast(c % 6 AS varchar) END AS dependents
  FROM orders_base""")
NUMERIC = [
    "revolving_utilisation", "age", "times_30_59_dpd", "debt_ratio", "monthly_income", "open_credit_lines", "times_90_dpd",
    "real_estate_lines", "times_60_89_dpd", "dependents",
]
_add("typed", ["raw"], "SELECT try_cast(trim(applicant_id) AS bigint) AS applicant_id, try_cast(trim(target_default_90dpd_2yr) AS int) AS target_default_90dpd_2yr, "
     + ", ".join(f"try_cast(trim({c}) AS double) AS {c}" for c in NUMERIC) + " FROM raw")
KEY = ", ".join(["target_default_90dpd_2yr", *NUMERIC])
_add("deduped", ["typed"], f"SELECT min(applicant_id) AS applicant_id, {KEY} FROM typed GROUP BY ALL")
_COUNTERS = ["times_30_59_dpd", "times_60_89_dpd", "times_90_dpd"]
_add("sentinel_free", ["deduped"], "SELECT * REPLACE ("
     + ", ".join(f"CASE WHEN {c} IN (96, 98) THEN NULL ELSE {c} END AS {c}" for c in _COUNTERS)
     + ", CASE WHEN NOT (age < 18 OR age > 100) THEN age END AS age), cast((" + " OR ".join(f"{c} IN (96, 98)" for c in _COUNTERS)
     + ") AS int) AS flag_delinquency_sentinel, cast((age < 18 OR age > 100) AS int) AS hit_age FROM deduped")
_add("unit_split", ["sentinel_free"], """
  SELECT * REPLACE (CASE WHEN monthly_income IS NULL AND debt_ratio > 100 THEN NULL ELSE debt_ratio END AS debt_ratio),
    cast((monthly_income IS NULL AND debt_ratio > 100) AS int) AS flag_debt_ratio_is_amount,
    CASE WHEN monthly_income IS NULL AND debt_ratio > 100 THEN debt_ratio END AS monthly_debt_amount,
    cast((monthly_income IS NULL) AS int) AS flag_monthly_income_missing, cast((dependents IS NULL) AS int) AS flag_dependents_missing
  FROM sentinel_free""")
_WINSOR = {"revolving_utilisation": (0, 2), "debt_ratio": (0, 5), "monthly_income": (0, 50000), "dependents": (0, 10)}
_add("silver", ["unit_split"], "SELECT * REPLACE ("
     + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, cast({lo} AS double)), cast({hi} AS double)) END AS {c}" for c, (lo, hi) in _WINSOR.items())
     + "), " + ", ".join(f"coalesce(cast(({c} < {lo} OR {c} > {hi}) AS int), 0) AS hit_{c}" for c, (lo, hi) in _WINSOR.items()) + " FROM unit_split")
BAND = ("CASE WHEN age IS NULL THEN 'unknown' WHEN age < 30 THEN '18-29' WHEN age < 40 THEN '30-39' WHEN age < 50 THEN '40-49' "
        "WHEN age < 60 THEN '50-59' WHEN age < 70 THEN '60-69' ELSE '70+' END")
_add("medians", ["silver"], "SELECT quantile_disc(monthly_income, 0.5) AS income, quantile_disc(age, 0.5) AS age, quantile_disc(debt_ratio, 0.5) AS debt_ratio FROM silver")
_add("band_medians", ["silver", "medians"], f"SELECT {BAND} AS age_band, coalesce(quantile_disc(monthly_income, 0.5), (SELECT income FROM medians)) AS band_income FROM silver GROUP BY 1")
_add("imputed", ["silver", "medians", "band_medians"], f"""
  SELECT s.* REPLACE (coalesce(s.monthly_income, b.band_income, m.income) AS monthly_income, coalesce(s.age, m.age) AS age,
      coalesce(s.dependents, 0) AS dependents, coalesce(s.debt_ratio, m.debt_ratio) AS debt_ratio, coalesce(s.monthly_debt_amount, 0) AS monthly_debt_amount),
    b.age_band
  FROM (SELECT *, {BAND} AS band FROM silver) s JOIN band_medians b ON s.band = b.age_band CROSS JOIN medians m""")
SPLIT_BUCKET = md5u(f"cast(applicant_id AS varchar) || '|{SEED}'") + " % 1000"
_add("mixed", ["imputed"], """
  SELECT *, coalesce(times_30_59_dpd, 0) + coalesce(times_60_89_dpd, 0) + coalesce(times_90_dpd, 0) AS total_delinquencies,
    CASE WHEN times_90_dpd > 0 THEN 3.0::double WHEN times_60_89_dpd > 0 THEN 2.0::double WHEN times_30_59_dpd > 0 THEN 1.0::double ELSE 0.0::double END AS worst_delinquency_severity,
    greatest(open_credit_lines - real_estate_lines, 0) AS unsecured_lines,
    real_estate_lines / greatest(open_credit_lines, 1) AS real_estate_share_of_lines
  FROM imputed""")
_add("gold", ["mixed"], f"""
  SELECT applicant_id, target_default_90dpd_2yr,
    CASE WHEN {SPLIT_BUCKET} < 600 THEN 'train' WHEN {SPLIT_BUCKET} < 800 THEN 'valid' ELSE 'test' END AS split, age_band,
    revolving_utilisation, age, debt_ratio, monthly_income, open_credit_lines, real_estate_lines, dependents, times_30_59_dpd, times_60_89_dpd,
    times_90_dpd, monthly_debt_amount, total_delinquencies, worst_delinquency_severity,
    total_delinquencies / greatest(open_credit_lines, 1) AS delinquencies_per_credit_line, unsecured_lines, real_estate_share_of_lines,
    monthly_income * debt_ratio AS monthly_debt_service, monthly_income - monthly_income * debt_ratio AS disposable_income,
    monthly_income / (1 + dependents) AS income_per_dependent, ln(1 + greatest(monthly_income, 0)) AS log_monthly_income,
    revolving_utilisation * (1 + total_delinquencies) AS utilisation_x_delinquency,
    flag_delinquency_sentinel, flag_monthly_income_missing, flag_debt_ratio_is_amount
  FROM mixed""")
_add("train_long", ["gold"], "SELECT applicant_id, y, feature, value FROM (SELECT applicant_id, target_default_90dpd_2yr AS y, "
     + ", ".join(f"cast({f} AS double) AS {f}" for f in MODEL_FEATURES) + " FROM gold WHERE split = 'train') UNPIVOT INCLUDE NULLS (value FOR feature IN ("
     + ", ".join(MODEL_FEATURES) + "))")
_add("edges", ["train_long"], """
  SELECT feature, CASE WHEN count(DISTINCT value) <= 1 THEN cast([] AS double[]) ELSE
    list_sort(list_distinct(list_transform(quantile_cont(value, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]), lambda q: round(q, 10)))) END AS edges
  FROM train_long GROUP BY feature""")
_add("fixed_edges", [], "SELECT * FROM (VALUES "
     + ", ".join(f"('{f}', cast({e} AS double[]))" for f, e in FIXED_EDGES.items()) + ") AS t(feature, edges)")


def bins_over(edges: str) -> dict[str, str]:
    """Counts, WoE and IV per (feature, bin) of the training rows, for a table of edges."""
    return {
        "binned": f"""SELECT l.feature, y, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e < value)) END AS bin_index
            FROM train_long l JOIN {edges} USING (feature)""",
        "bin_counts": "SELECT feature, bin_index, count(*) AS count, cast(sum(1 - y) AS bigint) AS goods, cast(sum(y) AS bigint) AS bads FROM binned GROUP BY ALL",
        "all_bins": f"""SELECT feature, unnest(range(len(edges) + 1)) AS bin_index FROM {edges}
            UNION ALL SELECT feature, -1 FROM bin_counts WHERE bin_index = -1""",
        "totals": "SELECT feature, cast(sum(goods) AS double) AS g, cast(sum(bads) AS double) AS b FROM bin_counts GROUP BY 1",
        "shares": """SELECT feature, bin_index, coalesce(count, 0) AS count, coalesce(goods, 0) AS goods, coalesce(bads, 0) AS bads,
            (coalesce(goods, 0) + 0.5::double) / (g + 1) AS share_good, (coalesce(bads, 0) + 0.5::double) / (b + 1) AS share_bad
            FROM all_bins LEFT JOIN bin_counts USING (feature, bin_index) JOIN totals USING (feature)""",
        "woe": """SELECT feature, cast(bin_index AS int) AS bin_index, count, goods, bads, cast(bads AS double) / greatest(count, 1) AS bad_rate,
            ln(share_good / share_bad) AS woe, (share_good - share_bad) * ln(share_good / share_bad) AS iv_contribution FROM shares""",
    }


def bin_label(edges: str = "edges", index: str = "bin_index") -> str:
    """Interval that a bin of a list of cut points stands for."""
    cut = lambda i: f"format('{{:g}}', {edges}[{i}])"
    low = f"CASE WHEN {index} = 0 THEN '(-inf' ELSE '(' || {cut(index)} END"
    high = f"CASE WHEN {index} = len({edges}) THEN 'inf)' ELSE {cut(f'{index} + 1')} || ']' END"
    return f"CASE WHEN {index} = -1 THEN 'Missing' ELSE {low} || ', ' || {high} END"


_add("scored", [], f"""
  SELECT id, cast(pm AS double) / 1000 AS p, CASE WHEN w < pm THEN 1 ELSE 0 END AS y, seg FROM (
    SELECT id, seg, w, 20 + (60 * u) // 16 + CASE WHEN v = 0 THEN 400 ELSE 0 END AS pm FROM (
      SELECT o_orderkey AS id, o_orderpriority AS seg, {md5u("cast(o_orderkey AS varchar) || '|p'")} % 16 AS u,
        {md5u("cast(o_orderkey AS varchar) || '|p'")} % 11 AS v, {md5u("cast(o_orderkey AS varchar) || '|y'")} % 1000 AS w FROM orders))""")
_add("ledger", [], """
  SELECT applicant_id, day, concat_ws(' ', upper(true_category), chr(cast(65 + k % 5 AS int)), cast(1000 + k AS varchar)) AS description,
    CASE WHEN true_category = 'income' THEN 4 * raw_cents ELSE -raw_cents END AS cents, true_category, transaction_id,
    cast(CASE WHEN true_category = 'income' THEN 4 * raw_cents ELSE -raw_cents END AS double) / 100 AS amount
  FROM (SELECT user_id AS applicant_id, event_id AS transaction_id,
      cast(floor((epoch_us(ts) - 1704067200000000) / cast(1000000 AS double) / cast(86400 AS double) * 6) AS int) AS day,
      cast(round(value * 100) AS bigint) AS raw_cents, k,
      CASE event_type WHEN 'signup' THEN 'income' WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'groceries' ELSE 'transport' END
        WHEN 'view' THEN CASE WHEN k % 2 = 0 THEN 'eating_out' ELSE 'shopping' END
        WHEN 'purchase' THEN CASE k % 3 WHEN 0 THEN 'housing' WHEN 1 THEN 'utilities' ELSE 'subscriptions' END
        WHEN 'error' THEN CASE k % 4 WHEN 0 THEN 'cash' WHEN 1 THEN 'debt_repayment' WHEN 2 THEN 'fees' ELSE 'transfers' END END AS true_category
    FROM (SELECT *, cast(json_extract_string(props, '$.k') AS int) AS k FROM events))""")
_add("banked", ["ledger"], """
  SELECT *, cast(20000 + sum(cents) OVER (PARTITION BY applicant_id ORDER BY transaction_id ROWS UNBOUNDED PRECEDING) AS double) / 100 AS balance_after FROM ledger""")
_add("stemmed", ["ledger"], "SELECT *, trim(regexp_replace(description, '\\d+', '', 'g')) AS merchant_stem FROM ledger")
_add("drift_rows", ["scored"], """
  SELECT id, p, o_totalprice AS price, cast(CASE WHEN id % 20 = 0 THEN 1 + id % 3 ELSE 0 END AS double) AS arrears,
    cast(CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND id % 2 = 0 THEN 5 WHEN id % 20 = 0 THEN 1 + id % 3 ELSE 0 END AS double) AS arrears_drifted,
    o_orderdate < TIMESTAMP '1998-01-01' AS is_reference
  FROM scored JOIN orders ON o_orderkey = id""")
