"""Boosted trees on blocks: the library's trees where nothing is drawn, its rule to stop, and no round fitted twice."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from gradus.operators import boosting
from gradus.operators import fitting as fit
from gradus.operators.trees import Trees

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def book(spark):
    r = random.Random(5)
    rows = []
    for i in range(900):
        a, b, d = r.random(), r.gauss(0, 1), r.randrange(3)
        rows.append((i, None if i % 13 == 0 else a, "nan" if i % 17 == 0 else str(round(b, 4)), 7.0, d, int(r.random() < 0.2 + 0.4 * (a > 0.6) * (b > 0) + 0.1 * d)))
    return spark.createDataFrame(rows, "id long, a double, b string, c double, d int, y int").repartition(3, "id")


def grown(train, valid, subsample=1.0, share="all", step=0.3, depth=4):
    return boosting.Boosting(train, valid, NAMES, F.col("y"), depth, step, subsample, share, 20, 42)


def assert_same_trees(found, want):
    assert found.features == want.features and found.weights == want.weights and len(found.trees) == len(want.trees)
    for nodes, others in zip(found.trees, want.trees):
        assert [(n.feature, n.threshold, n.left, n.right) for n in nodes] == [(n.feature, n.threshold, n.left, n.right) for n in others]
        assert [n.value for n in nodes if n.feature is None] == pytest.approx([n.value for n in others if n.feature is None], abs=1e-9)


@pytest.mark.parametrize("depth", [1, 4])
def test_without_draws_the_trees_are_the_librarys(spark, book, monkeypatch, depth):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 70)
    monkeypatch.setattr(boosting, "KEPT_ROUNDS", 4)
    train, valid = book.where("id % 3 != 0"), book.where("id % 3 = 0")
    model = grown(train, valid, depth=depth)
    model.to(2)
    losses = model.to(6)
    vectors = [fit.materialise(fit.tree_vector(df.select(*NAMES, "y"), NAMES).select("_x", F.col("y").cast("double").alias("label"))) for df in (train, valid)]
    want = GBTClassifier(featuresCol="_x", labelCol="label", maxIter=6, maxDepth=depth, stepSize=0.3, subsamplingRate=1.0, featureSubsetStrategy="all", minInstancesPerNode=20, seed=42).fit(vectors[0])
    assert_same_trees(model.model(6), Trees.of(want, NAMES))
    assert losses == pytest.approx(want.evaluateEachIteration(vectors[1]), abs=1e-9)


def test_large_books_are_not_fitted_again(spark, book, monkeypatch):
    monkeypatch.setattr(fit, "LIBRARY_ROWS", 100)
    monkeypatch.setattr(fit, "GBTClassifier", None)
    rounds, once = [], boosting.Boosting._grow
    monkeypatch.setattr(boosting.Boosting, "_grow", lambda self: (rounds.append(len(self.trees)), once(self)))
    train, valid = book.where("id % 3 != 0"), book.where("id % 3 = 0")
    found = fit.fit_challenger(train, valid, NAMES, "y", max_iter=12, patience=2, step=0.4)
    assert rounds == list(range(len(rounds))) and len(rounds) in (4, 8, 12)
    # The same rule as for small books, and the losses are those of the model that is returned.
    y, margin = (np.array(x) for x in zip(*((r["y"], r["m"]) for r in found.trees.margin(valid, "m").select("y", "m").collect())))
    again = boosting.Boosting(train, valid, NAMES, F.col("y"), 4, 0.4, 0.9, "0.8", 20, 42)
    losses, best = again.to(len(rounds)), len(found.trees.trees)
    assert best == fit.rounds_to_keep(losses, 2) or len(rounds) == 12 and best == 1 + int(np.argmin(losses))
    assert losses[best - 1] == pytest.approx(float(np.mean(2 * np.log1p(np.exp(-2 * (2 * y - 1) * margin)))), abs=1e-9)
    assert again.model(best) == found.trees

    # A loss that goes on falling: all rounds, each once.
    del rounds[:]
    monkeypatch.setattr(fit, "rounds_to_keep", lambda losses, patience: None)
    fit.fit_challenger(train, valid, NAMES, "y", max_iter=5, patience=1)
    assert rounds == list(range(5))


def test_rows_and_features_are_drawn(spark, book):
    train, valid = book.where("id % 3 != 0"), book.where("id % 3 = 0")
    model = grown(train, valid, subsample=0.5, share="0.25")
    model.to(6)
    roots = {t[0].feature for t in model.trees if t[0].feature}
    assert len(roots) > 1 and model.columns == 1
    assert 150 < model.root[0][0, 0].sum() < 450  # of 600 rows


def test_one_class_no_rows_held_out_and_other_labels(spark, book):
    alone = grown(book.withColumn("y", F.lit(1)), book.limit(0))
    losses = alone.to(2)
    assert [len(t) for t in alone.trees] == [1, 1] and alone.trees[0][0].value == 1.0 and all(map(math.isnan, losses))
    for wrong in (F.lit(2), F.lit(None).cast("int")):
        with pytest.raises(Exception, match="labels must be 0 or 1"):
            grown(book.withColumn("y", wrong), book)


def test_thresholds_are_placed_as_by_the_library():
    assert boosting.thresholds(np.array([3.0, 1.0, 1.0, 2.0])).tolist() == [1.5, 2.5]
    assert boosting.thresholds(np.array([4.0, 4.0])).tolist() == [] and boosting.thresholds(np.array([])).tolist() == []
    even = boosting.thresholds(np.arange(320.0))
    assert len(even) == 31 and even[0] == 9.5 and set(np.diff(even)) == {10.0}
    heavy = boosting.thresholds(np.r_[np.zeros(900), np.arange(1.0, 101.0)])
    assert heavy[0] == 0.5 and len(heavy) <= 31


def test_features_drawn_by_strategy():
    asked = [boosting.features_asked(s, 9) for s in ("all", "auto", "onethird", "sqrt", "log2", "0.8", "1.0", "4", "20")]
    assert asked == [9, 9, 3, 3, 4, 8, 9, 4, 9] and boosting.features_asked("sqrt", 1) == 1 == boosting.features_asked("log2", 1)
