"""Global order statistics against numpy, on the plain and on the bucketed path."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import evaluation as ev
from gradus.operators import ordering as o

RNG = np.random.default_rng(11)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_running_totals_match_cumsum(spark, limit):
    keys = RNG.permutation(500)
    rows = [(int(k % 3), float(k) / 7, int(k % 11)) for k in keys]
    got = o.running_totals(frame(spark, rows, "g int, k double, n long"), "k", ["n"], by=["g"], rows_per_bucket=limit)
    assert got.count() == 500
    by = {(r["g"], r["k"]): r["cum_n"] for r in got.collect()}
    for g in range(3):
        total = 0
        for _, k, n in sorted((x for x in rows if x[0] == g), key=lambda x: x[1]):
            total += n
            assert by[g, k] == total


@pytest.mark.parametrize("limit", [1_000_000, 30])
def test_running_totals_hot_group_and_null_group(spark, limit):
    rows = [("hot" if i % 3 else None, float(i), 1) for i in range(600)]
    got = o.running_totals(frame(spark, rows, "g string, k double, n long"), "k", ["n"], by=["g"], rows_per_bucket=limit)
    top = {r["g"]: r["m"] for r in got.groupBy("g").agg(F.max("cum_n").alias("m")).collect()}
    assert top == {"hot": 400, None: 200}


@pytest.mark.parametrize("limit", [1_000_000, 20])
@pytest.mark.parametrize("method", ["linear", "lower"])
def test_quantiles_match_numpy(spark, method, limit):
    probs = [0.0, 0.125, 0.5, 0.875, 1.0]
    columns = {
        "smooth": RNG.normal(size=700).tolist(),
        "zeros": [0.0] * 650 + RNG.uniform(size=50).tolist(),
        "ties": [float(v) for v in RNG.integers(-3, 4, 700)],
        "constant": [4.0] * 700,
        "gaps": [None if i % 3 else float(i) for i in range(700)],
        "absent": [None] * 700,
        "nan": [float("nan") if i % 2 else float(i) for i in range(700)],
    }
    df = frame(spark, list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    got = o.quantiles(df, list(columns), probs, method=method, sketch=50, rows_per_bucket=limit)
    how = {"linear": "linear", "lower": "inverted_cdf"}[method]
    for c, values in columns.items():
        present = [v for v in values if v is not None and v == v]
        assert got[None, c].n == len(present)
        if present:
            want = np.quantile(np.array(present), probs, method=how)
            np.testing.assert_allclose([got[None, c].values[p] for p in probs], want, rtol=0, atol=1e-12, err_msg=c)


def test_quantiles_by_group(spark):
    rows = [(f"g{i % 4}", float((i * 37) % 101)) for i in range(400)] + [(None, 5.0), ("it's", 7.0)]
    got = o.quantiles(frame(spark, rows, "g string, v double"), ["v"], [0.5], method="lower", by="g")
    for g in {r[0] for r in rows}:
        values = np.array([v for k, v in rows if k == g])
        assert got[g, "v"].values[0.5] == np.quantile(values, 0.5, method="inverted_cdf")


def test_quantiles_survive_a_wrong_bracket(spark, monkeypatch):
    """The approximation only says where to look: a bracket without its rank is widened."""
    real = o._disjoint
    monkeypatch.setattr(o, "_disjoint", lambda b: [(1e6, 1e6)] if b[0][0] > -1e300 else real(b))
    df = frame(spark, [(float(i),) for i in range(101)], "v double")
    assert o.quantiles(df, ["v"], [0.5])[None, "v"].values[0.5] == 50.0


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_grouped_median(spark, limit):
    rows = [(i % 5 if i % 3 else 9, float((i * 31) % 57)) for i in range(300)] + [(77, 4.0), (88, None)]
    got = {r["k"]: r["m"] for r in o.grouped_median(frame(spark, rows, "k int, v double"), ["k"], "v", "m", limit).collect()}
    want = {}
    for k, v in rows:
        if v is not None:
            want.setdefault(k, []).append(v)
    assert got == {k: float(np.median(v)) for k, v in want.items()}


def brute(p, y, ids, descending):
    order = sorted(range(len(p)), key=lambda i: (-p[i] if descending else p[i], ids[i]))
    return [p[i] for i in order], np.cumsum([y[i] for i in order])


@pytest.mark.parametrize("limit", [1_000_000, 25])
@pytest.mark.parametrize("descending", [False, True])
def test_totals_at_ranks_cut_through_ties(spark, descending, limit):
    n = 300
    # A third of all rows shares one score.
    p = [0.25 if i % 3 == 0 else round(float(v), 2) for i, v in enumerate(RNG.uniform(size=n))]
    y = [int(v) for v in RNG.integers(0, 2, n)]
    ids = [int(v) for v in RNG.permutation(n) + 10]
    df = frame(spark, list(zip(ids, p, y)), "id long, p double, y int")
    ranks = [1, 7, 60, 61, 150, 299, 300]
    got_n, bads, cuts = o.totals_at_ranks(df, "p", "y", "id", lambda _: ranks, descending, rows_per_bucket=limit)
    ordered, cumulative = brute(p, y, ids, descending)
    assert (got_n, bads) == (n, sum(y))
    for r in ranks:
        assert cuts[r].bads == cumulative[r - 1]
        assert cuts[r].p == ordered[r - 1]
        assert cuts[r].sum_p == pytest.approx(sum(ordered[:r]))


@pytest.mark.parametrize("limit", [1_000_000, 9])
def test_tables_by_rank_match_brute_force(spark, limit):
    n = 137
    p = [round(float(v), 1) for v in RNG.uniform(size=n)]
    y = [int(v) for v in RNG.integers(0, 2, n)]
    df = frame(spark, [(i, p[i], y[i]) for i in range(n)], "id long, p double, y int")
    order = sorted(range(n), key=lambda i: (p[i], i))
    gains = ev.gains_table(df, "p", "y", "id", rows_per_bucket=limit).collect()
    falling = sorted(range(n), key=lambda i: (-p[i], i))
    deciles = np.minimum((np.arange(n) * 10 // n) + 1, 10)
    for row in gains:
        members = [falling[i] for i in np.flatnonzero(deciles == row["decile"])]
        assert row["count"] == len(members) and row["bads"] == sum(y[i] for i in members)
    assert gains[-1]["cumulative_bad_capture"] == pytest.approx(1.0)
    calibration = ev.calibration_table(df, "p", "y", "id", rows_per_bucket=limit).collect()
    ranked = np.maximum(1, np.ceil(np.arange(n) * 10 / (n - 1))).astype(int)
    for row in calibration:
        members = [order[i] for i in np.flatnonzero(ranked == row["decile"])]
        assert row["count"] == len(members)
        assert row["predicted_rate"] == pytest.approx(np.mean([p[i] for i in members]))
        assert row["observed_rate"] == pytest.approx(np.mean([y[i] for i in members]))
    curve = ev.approval_curve(df, "p", "y", "id", rows_per_bucket=limit).collect()
    assert len(curve) == 100 and curve[-1]["accepted"] == n
    assert curve[-1]["expected_profit"] == (n - sum(y)) * 450.0 - sum(y) * 2800.0
    for row in curve:
        k = max(1, round(row["step"] / 100 * n))
        assert row["accepted"] == k
        assert row["bad_rate"] == pytest.approx(sum(y[i] for i in order[:k]) / k)
        assert row["score_cutoff_probability"] == p[order[k - 1]]


def test_small_and_empty_inputs(spark):
    few = frame(spark, [(i, 0.5, i % 2) for i in range(4)], "id long, p double, y int")
    assert sum(r["count"] for r in ev.gains_table(few, "p", "y", "id").collect()) == 4
    assert sum(r["count"] for r in ev.calibration_table(few, "p", "y", "id").collect()) == 4
    none = few.where("id < 0")
    assert ev.gains_table(none, "p", "y", "id").count() == 0
    assert ev.approval_curve(none, "p", "y", "id").count() == 0
    assert ev.calibration_table(none, "p", "y", "id").count() == 0


def test_ranks_are_met_without_a_nested_loop(spark, monkeypatch):
    """The join of scores and wanted ranks has a key; ranks in long ties and short stretches are found."""
    r = random.Random(12)
    rows = [(i, 0.5 if i % 3 else round(r.random(), 3), int(r.random() < 0.3)) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, p double, y int")
    ordered = sorted((p, i, y) for i, p, y in rows)
    plans = []
    real = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (plans.append(self._jdf.queryExecution().optimizedPlan().toString()), real(self))[1])
    for stretches in (1, 7, 100_000):
        monkeypatch.setattr(o, "RANK_STRETCHES", stretches)
        wanted = [1, 2, 13, 350, 351, 352, 699, 700]
        n, bads, cuts = o.totals_at_ranks(df, "p", "y", "id", lambda n: wanted)
        assert (n, bads) == (700, sum(y for _, _, y in ordered)) and sorted(cuts) == wanted
        for k, cut in cuts.items():
            assert cut.p == ordered[k - 1][0] and cut.bads == sum(y for _, _, y in ordered[:k])
            assert cut.sum_p == pytest.approx(sum(p for p, _, _ in ordered[:k]))
    assert any("stretch" in p and "= place" in p for p in plans)
