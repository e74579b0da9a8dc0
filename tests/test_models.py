"""The challenger as a table of nodes, and models that are published and read back."""

import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gradus.functions.columns import ScoreScaling
from gradus.operators import fitting as fit
from gradus.operators import text as tx
from gradus.operators.scoring import IsotonicCurve, PlattCurve, Scorecard, score
from gradus.operators.trees import Trees
from gradus.operators.woe import woe_fit
from gradus.sources import models

NAMES = ["a", "b", "c"]
BANDS = (("A", 600.0, "good"), ("B", 0.0, "rest"))


@pytest.fixture(scope="module")
def book(spark):
    r = random.Random(8)
    rows = []
    for i in range(900):
        a, b = r.random(), r.gauss(0, 1)
        rows.append((i, None if i % 13 == 0 else a, "nan" if i % 17 == 0 else str(round(b, 4)), r.random() * 1e-7, int(r.random() < 0.2 + 0.5 * (a > 0.6) * (b > 0))))
    return spark.createDataFrame(rows, "id long, a double, b string, c double, y int")


def boosted(book, rounds, depth=4):
    vectors = fit.tree_vector(book, NAMES).withColumn("label", F.col("y").cast("double"))
    return GBTClassifier(featuresCol="_x", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.05, minInstancesPerNode=5, seed=3).fit(vectors)


@pytest.mark.parametrize("rounds,depth", [(1, 0), (1, 4), (9, 4), (120, 5)])
def test_expressions_score_as_the_library_does(spark, book, rounds, depth):
    model = boosted(book, rounds, depth)
    trees = Trees.of(model, NAMES)
    assert len(trees.trees) == rounds and sum(map(len, trees.trees)) == model.totalNumNodes
    want = {r["id"]: r["p"] for r in model.transform(fit.tree_vector(book, NAMES)).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    for found in (trees, Trees.from_frame(trees.to_frame(spark), NAMES)):
        out = fit.Challenger(found).raw_probability(book, "p")
        assert out.columns == [*book.columns, "p"] and "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r["id"]: r["p"] for r in out.collect()}
        assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in want)


def test_challenger_is_permuted(spark, book):
    challenger = fit.Challenger(Trees.of(boosted(book, 20), NAMES))
    lost = {r["feature"]: r["auc_loss"] for r in fit.permutation_importance(book, NAMES, "y", "id", challenger.raw_probability).collect()}
    assert set(lost) == set(NAMES) and lost["a"] > 0.02 and lost["b"] > 0.02 and lost["a"] > lost["c"]


@pytest.mark.parametrize("curve", [None, PlattCurve(2.0, -0.5), IsotonicCurve([0.1, 0.4, 0.9], [0.05, 0.3, 0.8])])
def test_published_models_score_alike(spark, book, tmp_path, curve):
    root = str(tmp_path / "models")
    challenger = fit.Challenger(Trees.of(boosted(book, 12), NAMES), curve, ScoreScaling(500.0, 20.0, 25.0), BANDS)
    bins = woe_fit(book, ["a", "c"], "y")
    card = Scorecard(bins, {"c": -0.3, "a": -0.9}, -1.2, curve, ScoreScaling(500.0, 20.0, 25.0), BANDS)
    with pytest.raises(LookupError):
        models.read_model(spark, root, "challenger")
    for version in ("1", "2"):
        models.publish(spark, root, version, challenger if version == "2" else fit.Challenger(Trees.of(boosted(book, 1), NAMES)))
    models.publish(spark, root, "1", card)
    with pytest.raises(ValueError):
        models.publish(spark, root, "2", challenger)
    assert models.current_version(spark, root, "challenger") == "2" and models.publications(spark, root).count() == 3
    assert models.read_model(spark, root, "challenger") == challenger and models.read_model(spark, root, "scorecard") == card
    assert len(models.read_model(spark, root, "challenger", "1").trees.trees) == 1
    rows = lambda df: sorted(map(tuple, df.select("id", "probability_of_default", "raw_score", "score", "band").collect()))
    assert rows(models.read_model(spark, root, "challenger").score(book)) == rows(challenger.score(book))
    assert rows(score(book, models.read_model(spark, root, "scorecard"))) == rows(score(book, card))


def test_a_categoriser_is_published_too(spark, tmp_path):
    ledger = spark.createDataFrame([("UBER TRIP", "transport"), ("TESCO STORES", "groceries")] * 10, "description string, true_category string")
    model = tx.fit_categoriser(ledger, behaviour=False)
    models.publish(spark, str(tmp_path), "v1", model)
    read = models.read_model(spark, str(tmp_path), "categoriser")
    assert sorted(read.transform(ledger).collect()) == sorted(model.transform(ledger).collect())


def test_the_best_rounds_are_kept_without_another_fit(spark, book, monkeypatch):
    fits = []

    class Counted(GBTClassifier):
        def fit(self, data):
            fits.append(self.getMaxIter())
            return super().fit(data)

    monkeypatch.setattr(fit, "GBTClassifier", Counted)
    train, valid = book.where("id % 3 != 0"), book.where("id % 3 = 0")
    found = fit.fit_challenger(train, valid, NAMES, "y", max_iter=48, patience=4, step=0.4)
    best = len(found.trees.trees)
    assert best < fits[-1] and len(set(fits)) == len(fits)
    vectors = fit.materialise(fit.tree_vector(train.select(*NAMES, "y"), NAMES).select("_x", F.col("y").cast("double").alias("label")))
    again = GBTClassifier(featuresCol="_x", labelCol="label", maxIter=best, maxDepth=4, stepSize=0.4, subsamplingRate=0.9,
                          featureSubsetStrategy="0.8", minInstancesPerNode=20, seed=42).fit(vectors)
    assert found.trees == Trees.of(again, NAMES)

    # A loss that goes on falling: 8 and 16 rounds, then all of them at once.
    del fits[:]
    monkeypatch.setattr(fit, "rounds_to_keep", lambda losses, patience: 20 if len(losses) == 32 else None)
    assert len(fit.fit_challenger(train, valid, NAMES, "y", max_iter=48, patience=4).trees.trees) == 20 and fits == [8, 16, 48]
