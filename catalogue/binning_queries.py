"""Weight of Evidence, Information Value and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.ctes import bin_label, bins_over, with_
from catalogue.fixed import FIXED_EDGES
from catalogue.inputs import r6, splits
from gradus.functions.columns import iv_strength
from gradus.operators import selection as sel
from gradus.operators import woe
from gradus.operators.features import MODEL_FEATURES, TARGET
from gradus.operators.joint import bin_values, correlations, counts_by_bin, joint_bin_counts
from gradus.sources.tables import materialise

FIXED = list(FIXED_EDGES)


def _train(spark, sf):
    return splits(spark, sf)[0]


def _coarse(spark, sf):
    return woe.woe_fit(_train(spark, sf), MODEL_FEATURES, TARGET, monotone=False)


def _fixed(train):
    return woe.woe_fit(train, FIXED, TARGET, monotone=False, edges=FIXED_EDGES)


def d01_edges(spark, sf):
    edges = woe.coarse_edges(_train(spark, sf), MODEL_FEATURES)
    flat = [(f, i, v) for f, e in edges.items() for i, v in enumerate(e)]
    return spark.createDataFrame(flat, "feature string, position int, edge double")


def d02_bin_assignment(spark, sf):
    from gradus.functions.columns import bin_index, number

    train = _train(spark, sf)
    numbers = train.select("applicant_id", *[number(f).alias(f) for f in FIXED])
    return numbers.select("applicant_id", *[bin_index(f, e).alias(f"bin_{f}") for f, e in FIXED_EDGES.items()])


def d03_bin_counts(spark, sf):
    train = _train(spark, sf)
    return woe.bin_counts(train, woe.coarse_edges(train, MODEL_FEATURES), TARGET)


def d06_monotone_bins(spark, sf):
    return woe.woe_fit(_train(spark, sf), MODEL_FEATURES, TARGET).table(spark).withColumns(r6("bad_rate", "woe", "iv_contribution"))


def d07_woe_iv_coarse(spark, sf):
    return _coarse(spark, sf).table(spark).withColumns(r6("bad_rate", "woe", "iv_contribution"))


def d10_woe_transform_fixed_bins(spark, sf):
    train = _train(spark, sf)
    out = woe.woe_transform(train, _fixed(train), FIXED)
    return out.select("applicant_id", *[F.round(f"woe_{f}", 6).alias(f"woe_{f}") for f in FIXED])


def d12_iv_rank(spark, sf):
    return woe.information_values(_coarse(spark, sf).table(spark)).drop("strength").withColumns(r6("information_value"))


def d14_iv_floor(spark, sf):
    return sel.iv_floor(_coarse(spark, sf).table(spark)).select("feature")


def d15_strength(spark, sf):
    return woe.information_values(_coarse(spark, sf).table(spark)).select("feature", iv_strength(F.col("information_value")).alias("strength"))


def d16_degenerate(spark, sf):
    """Beside the model's features one that says nothing but whether it was reported."""
    train = _train(spark, sf).withColumn("reported", F.when(F.col("applicant_id") % 3 != 0, F.lit(1.0)))
    return sel.degenerate_features(woe.woe_fit(train, [*MODEL_FEATURES, "reported"], TARGET, monotone=False).table(spark))


def _narrow(spark, sf):
    return materialise(_train(spark, sf).select(TARGET, *MODEL_FEATURES))


def d17_corr_pairs(spark, sf):
    train = _narrow(spark, sf)
    edges = woe.coarse_edges(train, MODEL_FEATURES)
    joint = materialise(joint_bin_counts(train, edges, TARGET))
    bins = woe.bins_of_counts(counts_by_bin(joint, TARGET), edges, monotone=False)
    return correlations(joint, bin_values(bins, edges), MODEL_FEATURES).withColumns(r6("corr"))


def d18_selection(spark, sf):
    return sel.fit_and_select(_narrow(spark, sf), MODEL_FEATURES, TARGET)[1].report(spark).withColumns(r6("information_value"))


def f14_top_iv(spark, sf):
    return woe.top_information_values(_coarse(spark, sf).table(spark), 14).select("feature", F.round("information_value", 6).alias("information_value"))


QUERIES = {f.__name__: f for f in (
    d01_edges, d02_bin_assignment, d03_bin_counts, d06_monotone_bins, d07_woe_iv_coarse, d10_woe_transform_fixed_bins, d12_iv_rank, d14_iv_floor,
    d15_strength, d16_degenerate, d17_corr_pairs, d18_selection, f14_top_iv,
)}

_COARSE = with_("train_long", "edges", extra=bins_over("edges"))
_IV = "SELECT feature, sum(iv_contribution) AS iv FROM woe GROUP BY 1"
_FIXED_BINS = bins_over("fixed_edges")
_FIXED_WIDE = {
    **_FIXED_BINS,
    "placed": """SELECT applicant_id, l.feature, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e < value)) END AS bin_index
        FROM train_long l JOIN fixed_edges USING (feature)""",
    "wide": "SELECT applicant_id, " + ", ".join(f"max(woe) FILTER (feature = '{f}') AS {f}" for f in FIXED)
    + " FROM placed JOIN woe USING (feature, bin_index) GROUP BY 1",
}
_COARSE_WIDE = {
    **bins_over("edges"),
    "placed": """SELECT applicant_id, l.feature, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e < value)) END AS bin_index
        FROM train_long l JOIN edges USING (feature)""",
    "wide": "SELECT applicant_id, " + ", ".join(f"max(woe) FILTER (feature = '{f}') AS {f}" for f in MODEL_FEATURES)
    + " FROM placed JOIN woe USING (feature, bin_index) GROUP BY 1",
}
_CORR = "CASE WHEN stddev_pop({0}) > 1e-9 AND stddev_pop({1}) > 1e-9 THEN corr({0}, {1}) END"
_PAIRS = [(a, b) for i, a in enumerate(MODEL_FEATURES) for b in MODEL_FEATURES[i + 1 :]]

# The merge rules as a recursion over lists: one merge per step, small bins first, then the
# pair that breaks the trend most.
_RATES = "list_transform(range(1, len(g) + 1), lambda i: b[i] / greatest(g[i] + b[i], 1))"
_MERGED = {
    **bins_over("edges"),
    "finite": "SELECT feature, list(goods::double ORDER BY bin_index) AS g, list(bads::double ORDER BY bin_index) AS b FROM woe WHERE bin_index >= 0 GROUP BY 1",
    "start": """SELECT feature, 1 AS phase, greatest(1, 0.05::double * (list_sum(g) + list_sum(b))) AS need, g, b, edges AS e FROM finite JOIN edges USING (feature)""",
    "sized": f"""SELECT feature, g, b, e FROM (
        WITH RECURSIVE step AS (
          SELECT feature, need, g, b, e, 0 AS n FROM start
          UNION ALL
          SELECT feature, need, g[1:l - 1] || [g[l] + g[l + 1]] || g[l + 2:], b[1:l - 1] || [b[l] + b[l + 1]] || b[l + 2:], e[1:l - 1] || e[l + 1:], n + 1
          FROM (SELECT *, least(coalesce(list_position(list_transform(range(1, len(g) + 1), lambda i: g[i] + b[i] < need), true), 0), len(g) - 1) AS l FROM step WHERE len(g) > 1)
          WHERE l >= 1)
        SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC) AS last FROM step) WHERE last = 1""",
    "trended": f"""SELECT *, CASE WHEN list_sum(list_transform(range(1, len(g) + 1), lambda i: (i - (len(g) + 1) / 2::double) * r[i])) < 0
          AND list_max(list_transform(r, lambda x: abs(x - r[1]) - 1e-8::double - 1e-5::double * abs(r[1]))) > 0 THEN -1 ELSE 1 END AS trend
        FROM (SELECT *, {_RATES} AS r FROM sized)""",
    "monotone": f"""SELECT feature, g, b, e FROM (
        WITH RECURSIVE step AS (
          SELECT feature, trend, g, b, e, 0 AS n FROM trended
          UNION ALL
          SELECT feature, trend, g[1:l - 1] || [g[l] + g[l + 1]] || g[l + 2:], b[1:l - 1] || [b[l] + b[l + 1]] || b[l + 2:], e[1:l - 1] || e[l + 1:], n + 1
          FROM (SELECT *, list_position(d, list_min(d)) AS l FROM (
            SELECT *, list_transform(range(1, len(g)), lambda i: (r[i + 1] - r[i]) * trend) AS d FROM (SELECT *, {_RATES} AS r FROM step WHERE len(g) > 1))
            WHERE list_min(d) < 0))
        SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC) AS last FROM step) WHERE last = 1""",
    "merged": """SELECT feature, cast(i - 1 AS int) AS bin_index, g[i] AS goods, b[i] AS bads FROM (SELECT *, unnest(range(1, len(g) + 1)) AS i FROM monotone)
        UNION ALL SELECT feature, -1, goods::double, bads::double FROM bin_counts WHERE bin_index = -1""",
    "merged_shares": "SELECT feature, bin_index, goods, bads, (goods + 0.5::double) / (g + 1) AS sg, (bads + 0.5::double) / (b + 1) AS sb FROM merged JOIN totals USING (feature)",
}
# Selection: floor, degenerate bins, and a walk in IV order that a feature survives if none of
# the survivors before it correlates too much with it.
_SELECTED = {
    **_MERGED,
    "merged_woe": "SELECT feature, bin_index, ln(sg / sb) AS woe, (sg - sb) * ln(sg / sb) AS iv FROM merged_shares",
    "placed": """SELECT applicant_id, l.feature, CASE WHEN value IS NULL THEN -1 ELSE len(list_filter(e, lambda c: c < value)) END AS bin_index
        FROM train_long l JOIN monotone USING (feature)""",
    "wide": "SELECT applicant_id, " + ", ".join(f"max(woe) FILTER (feature = '{f}') AS {f}" for f in MODEL_FEATURES)
    + " FROM placed JOIN merged_woe USING (feature, bin_index) GROUP BY 1",
    "pairs": "SELECT unnest([" + ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': {_CORR.format(a, b)}}}" for a, b in _PAIRS) + "], recursive := true) FROM wide",
    "rated": """SELECT feature, sum(iv) AS iv, CASE WHEN sum(iv) < 0.02 THEN 'IV below floor'
        WHEN count(*) FILTER (bin_index >= 0) < 2 THEN 'single populated bin - no separation among observed values' END AS reason FROM merged_woe GROUP BY 1""",
    "ranked": "SELECT feature, iv, row_number() OVER (ORDER BY iv DESC, feature) AS i FROM rated WHERE reason IS NULL",
    "rivals": """SELECT w.feature, w.i, list({'name': s.feature, 'r': abs(r)} ORDER BY s.i) FILTER (s.feature IS NOT NULL) AS met
        FROM ranked w LEFT JOIN (SELECT a, b, r FROM pairs UNION ALL SELECT b, a, r FROM pairs) p ON p.b = w.feature AND abs(r) >= 0.85
        LEFT JOIN ranked s ON s.feature = p.a AND s.i < w.i GROUP BY ALL""",
    "walked": """SELECT feature, hit FROM (
        WITH RECURSIVE step AS (
          SELECT 0::bigint AS i, cast([] AS varchar[]) AS kept, cast(NULL AS varchar) AS feature, cast(NULL AS struct(name varchar, r double)) AS hit
          UNION ALL
          SELECT i, CASE WHEN hit IS NULL THEN kept || [feature] ELSE kept END, feature, hit
          FROM (SELECT n.i, kept, n.feature, list_filter(n.met, lambda m: list_contains(kept, m.name))[1] AS hit FROM step JOIN rivals n ON n.i = step.i + 1))
        SELECT * FROM step) WHERE feature IS NOT NULL""",
}

ORACLES = {
    "d18_selection": with_("train_long", "edges", extra=_SELECTED) + """SELECT feature, round(iv, 6) AS information_value,
        CASE WHEN iv < 0.02 THEN 'unpredictive' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium' WHEN iv < 0.5 THEN 'strong' ELSE 'suspiciously strong - check for leakage' END AS strength,
        reason IS NULL AND hit IS NULL AS selected, coalesce(reason, 'correlated ' || printf('%.2f', hit.r) || ' with ' || hit.name, '') AS exclusion_reason
        FROM rated LEFT JOIN walked USING (feature)""",
    "d06_monotone_bins": with_("train_long", "edges", extra=_MERGED) + f"""SELECT feature, bin_index, {bin_label('e')} AS bin, cast(goods + bads AS bigint) AS count, cast(goods AS bigint) AS goods,
        cast(bads AS bigint) AS bads, round(bads / greatest(goods + bads, 1), 6) AS bad_rate, round(ln(sg / sb), 6) AS woe, round((sg - sb) * ln(sg / sb), 6) AS iv_contribution FROM merged_shares JOIN monotone USING (feature)""",
    "d01_edges": with_("edges") + "SELECT feature, cast(i AS int) AS position, edges[i + 1] AS edge FROM (SELECT feature, edges, unnest(range(len(edges))) AS i FROM edges)",
    "d02_bin_assignment": with_("fixed_edges", "train_long", extra=_FIXED_WIDE) + "SELECT applicant_id, "
    + ", ".join(f"cast(max(bin_index) FILTER (feature = '{f}') AS int) AS bin_{f}" for f in FIXED) + " FROM placed GROUP BY 1",
    "d03_bin_counts": _COARSE + "SELECT feature, cast(bin_index AS int) AS bin_index, count, goods, bads FROM bin_counts",
    "d07_woe_iv_coarse": _COARSE + f"""SELECT feature, bin_index, {bin_label()} AS bin, count, goods, bads, round(bad_rate, 6) AS bad_rate, round(woe, 6) AS woe,
        round(iv_contribution, 6) AS iv_contribution FROM woe JOIN edges USING (feature)""",
    "d10_woe_transform_fixed_bins": with_("fixed_edges", "train_long", extra=_FIXED_WIDE) + "SELECT applicant_id, "
    + ", ".join(f"round({f}, 6) AS woe_{f}" for f in FIXED) + " FROM wide",
    "d12_iv_rank": _COARSE + f"SELECT feature, round(iv, 6) AS information_value FROM ({_IV})",
    "d14_iv_floor": _COARSE + f"SELECT feature FROM ({_IV}) WHERE iv >= 0.02",
    "d15_strength": _COARSE + f"""SELECT feature, CASE WHEN iv < 0.02 THEN 'unpredictive' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium'
        WHEN iv < 0.5 THEN 'strong' ELSE 'suspiciously strong - check for leakage' END AS strength FROM ({_IV})""",
    "d16_degenerate": _COARSE + """SELECT feature, count(*) FILTER (bin_index <> -1) AS finite_bins FROM woe GROUP BY 1 HAVING count(*) FILTER (bin_index <> -1) < 2
        UNION ALL SELECT 'reported', count(DISTINCT CASE WHEN applicant_id % 3 <> 0 THEN 1 END) FROM gold WHERE split = 'train'""",
    "d17_corr_pairs": with_("train_long", "edges", extra=_COARSE_WIDE) + "SELECT unnest([" + ", ".join(
        f"{{'a': '{a}', 'b': '{b}', 'corr': CASE WHEN stddev_pop({a}) > 1e-9 AND stddev_pop({b}) > 1e-9 THEN round(corr({a}, {b}), 6) END}}" for a, b in _PAIRS
    ) + "], recursive := true) FROM wide",
    "f14_top_iv": _COARSE + f"SELECT feature, round(iv, 6) AS information_value FROM ({_IV}) ORDER BY iv DESC, feature LIMIT 14",
}
