"""Results that must not depend on size, and checks that must be able to fail."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import evaluation as ev
from gradus.operators import fitting as fit
from gradus.operators import ordering as o
from gradus.operators import quality as q
from gradus.operators import text as tx
from gradus.sources import tables


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_running_totals_keep_null_nan_and_ties(spark, limit):
    keys = [None, None, math.nan, math.nan, math.inf, -math.inf, 0.0] + [float(i % 7) for i in range(40)]
    rows = [(i, k, 1 + i % 3) for i, k in enumerate(keys)]
    got = o.running_totals(spark.createDataFrame(rows, "i int, k double, n long"), "k", ["n"], ties=["i"], rows_per_bucket=limit).collect()
    place = lambda r: (r[1] is not None, math.isnan(r[1] or 0), r[1] or 0.0 if not math.isnan(r[1] or 0) else 0.0, r[0])
    total, want = 0, {}
    for r in sorted(rows, key=place):
        total += r[2]
        want[r[0]] = total
    assert {r.i: r.cum_n for r in got} == want


def test_running_totals_of_nulls_alone(spark):
    df = spark.createDataFrame([(None, 1)] * 30, "k double, n long")
    assert sorted(r.cum_n for r in o.running_totals(df, "k", ["n"], rows_per_bucket=10).collect()) == list(range(1, 31))


def test_permutation_importance_is_the_same_for_any_split(spark):
    r = np.random.default_rng(3)
    rows = [(i, float(r.normal()), float(r.normal()), int(r.random() < 0.4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    raw = lambda d, out: d.withColumn(out, F.col("a") + 0.1 * F.col("b"))
    one, many = (
        sorted(map(tuple, fit.permutation_importance(df, ["a", "b"], "y", "id", raw, rows_per_bucket=n).collect())) for n in (1_000_000, 7)
    )
    assert one == many


def test_patience():
    assert fit.rounds_to_keep([3.0, 2.0, 2.5, 2.4], 3) is None
    assert fit.rounds_to_keep([3.0, 2.0, 2.5, 2.4, 2.3], 3) == 2
    assert fit.rounds_to_keep([1.0], 0) == 1


def test_challenger_goes_past_the_first_tree(spark):
    r = np.random.default_rng(5)
    rows = []
    for i in range(1_500):
        a, b = r.uniform(size=2)
        rows.append((i, float(a), float(b), int(r.random() < 1 / (1 + math.exp(-4 * (a - b) ** 2 * 6 + 3)))))
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    train, valid, test = (df.where(F.col("id") % 3 == i) for i in range(3))
    found = fit.fit_challenger(train, valid, ["a", "b"], "y", max_iter=24, patience=6)
    single = fit.fit_challenger(train, valid, ["a", "b"], "y", max_iter=1, patience=0)
    assert len(found.trees.trees) > 1 and len(single.trees.trees) == 1
    auc = [ev.auc_gini(m.raw_probability(test, "p"), "p", "y").first().auc for m in (found, single)]
    assert auc[0] > auc[1]


@pytest.mark.parametrize("labels,count,passed", [
    (["train", "valid", "test"], 3, True), (["train", "valid", None], 2, False), (["train", "valid", "foo", "bar"], 4, False),
])
def test_expected_splits_are_counted(spark, labels, count, passed):
    gold = spark.createDataFrame([(i, i % 10 == 0, s) for i, s in enumerate(labels * 10)], "applicant_id int, y boolean, split string").withColumn("y", F.col("y").cast("int"))
    row = q.gold_expectations(gold, target="y").where("check = 'splits'").first()
    assert row.value == count and row.passed == passed


def test_nan_text_is_counted_as_lost(spark):
    df = spark.createDataFrame([("NaN",), ("1.5",), ("x",), ("",), (None,)], "v string")
    assert [tuple(r) for r in q.cast_audit(df, {"v": "double"}).collect()] == [("v", 2)]


def test_histogram_of_nothing(spark):
    empty = spark.createDataFrame([], "s double, y int")
    assert ev.score_histogram(empty, "s", "y").count() == 0


def test_rows_without_a_description_are_categorised(spark):
    rows = [("UBER TRIP", "transport"), ("TESCO STORES", "groceries")] * 20
    model = tx.fit_categoriser(spark.createDataFrame(rows, "description string, true_category string"), behaviour=False)
    out = model.transform(spark.createDataFrame([("UBER", "transport"), (None, "groceries")], "description string, true_category string")).collect()
    assert len(out) == 2 and all(r.category in ("transport", "groceries") for r in out)


def test_an_append_keeps_the_schema(spark, tmp_path):
    dest = str(tmp_path / "decisions")
    tables.append_decisions(spark.createDataFrame([(1, 600)], "id long, score int"), dest, "1")
    tables.append_decisions(spark.createDataFrame([(2, 610)], "id long, score int"), dest, "1")
    for other in (spark.createDataFrame([(3, 6.5)], "id long, score double"), spark.createDataFrame([(3,)], "id long")):
        with pytest.raises(ValueError):
            tables.append_decisions(other, dest, "1")
    assert spark.read.parquet(dest).count() == 2


def test_candidates_are_fitted_on_the_selected_features(spark, monkeypatch):
    """e01, e02 and e13 fit what selection keeps of all model features, not hand-picked columns."""
    from catalogue import scoring_queries as q
    from catalogue.inputs import splits
    from gradus.operators.features import MODEL_FEATURES, TARGET
    from gradus.operators.selection import select_features
    from gradus.operators.woe import woe_fit
    from gradus.sources.tables import materialise

    sf = "/root/testdata/sf0.01"
    train = materialise(splits(spark, sf)[0])
    selected = select_features(train, woe_fit(train, MODEL_FEATURES, TARGET)).selected
    assert selected and set(selected) != set(q.FEATURES)
    assert {r.feature for r in q.e01_logistic(spark, sf).collect()} == {"intercept", *selected}

    class Fitted(Exception):
        pass

    def challenger(train, valid, features, target):
        raise Fitted(sorted(features))

    monkeypatch.setattr(q.fit, "fit_challenger", challenger)
    for query in (q.e02_boosted, q.e13_candidates):
        with pytest.raises(Fitted) as found:
            query(spark, sf)
        assert found.value.args[0] == sorted(selected)


def test_a_batch_is_appended_once(spark, tmp_path, monkeypatch):
    dest = str(tmp_path / "decisions")
    rows = lambda *ids: spark.createDataFrame([(i, 600 + i) for i in ids], "id long, score int")
    assert tables.append_decisions(rows(1, 2), dest, "1", batch="day 1")
    assert not tables.append_decisions(rows(1, 2), dest, "1", batch="day 1")
    assert tables.append_decisions(rows(3), dest, "1", batch="day 2/x")

    # A job that dies after its rows are written and before they are committed.
    with monkeypatch.context() as m:
        m.setattr(tables, "_COMMITS", "_elsewhere/_commits")
        tables.append_decisions(rows(4), dest, "1", batch="day 3")
    assert spark.read.parquet(dest).count() == 4 and {r.id for r in tables.read_appended(spark, dest).collect()} == {1, 2, 3}
    assert tables.append_decisions(rows(4), dest, "1", batch="day 3")

    # Two writers that both found the batch missing: the first commit counts.
    missing = tables.commits
    with monkeypatch.context() as m:
        m.setattr(tables, "commits", lambda spark, dest: missing(spark, dest).limit(0))
        tables.append_decisions(rows(4), dest, "1", batch="day 3")
    seen = tables.read_appended(spark, dest)
    assert sorted((r.id, r.batch) for r in seen.collect()) == [(1, "day 1"), (2, "day 1"), (3, "day 2/x"), (4, "day 3")]
    assert tables.commits(spark, dest).count() == 3 and tables.commits(spark, str(tmp_path / "none")).count() == 0
