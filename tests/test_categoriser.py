"""The merchant categoriser next to numpy, saved and loaded."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import text as tx
from gradus.operators.ledger import BEHAVIOUR

SHOPS = {"groceries": ["TESCO STORES", "ALDI", "FRESH MART"], "transport": ["UBER TRIP", "CITY RAIL", "FUEL STOP"], "fees": ["LATE FEE", "BANK FEE"]}


@pytest.fixture(scope="module")
def ledger(spark):
    r = random.Random(3)
    rows = []
    for i in range(600):
        category = r.choice(list(SHOPS))
        described = None if i % 97 == 0 else "" if i % 89 == 0 else f"{r.choice(SHOPS[category])} {r.randrange(20)}"
        rows.append((i, described, category, *[float(r.gauss(len(category), 2)) for _ in BEHAVIOUR]))
    schema = "id long, description string, true_category string, " + ", ".join(f"{c} double" for c in BEHAVIOUR)
    return spark.createDataFrame(rows, schema).repartition(4)


def grams(text):
    out = []
    for word in text.lower().split():
        padded = f" {word} "
        out += [padded[i : i + n] for n in range(2, min(5, len(padded)) + 1) for i in range(len(padded) - n + 1)]
    return out


def brute(model, row):
    known = {g.gram: g for g in model.grams.collect()} if not isinstance(model, tuple) else model[1]
    model = model[0] if isinstance(model, tuple) else model
    scores = np.array(model.intercepts)
    counts = {}
    for g in grams(row["description"] or ""):
        counts[g] = counts.get(g, 0) + 1
    cells = {g: (1 + math.log(n)) * known[g].idf for g, n in counts.items() if g in known}
    length = math.sqrt(sum(w * w for w in cells.values()))
    for g, w in cells.items():
        scores = scores + w / length * np.array(known[g].weights)
    for c, (mean, deviation) in model.scaler.items():
        scores = scores + (row[c] - mean) / deviation * np.array(model.behaviour[c])
    return model.classes[int(np.argmax(scores))]


@pytest.mark.parametrize("behaviour", [False, True])
def test_classes_as_numpy_finds_them_before_and_after_saving(spark, ledger, tmp_path, behaviour):
    model = tx.fit_categoriser(ledger, behaviour, max_iter=40)
    model.save(str(tmp_path / "model"))
    loaded = tx.Categoriser.load(spark, str(tmp_path / "model"))
    assert 0 < model.rounds <= 40 and (loaded.classes, loaded.intercepts, loaded.scaler, loaded.behaviour, loaded.rounds) == (model.classes, model.intercepts, model.scaler, model.behaviour, model.rounds)
    known = {g.gram: g for g in model.grams.collect()}
    want = {r["id"]: brute((model, known), r) for r in ledger.collect()}
    for m in (model, loaded):
        assert {r["id"]: r["category"] for r in m.transform(ledger).collect()} == want
    guessed = model.transform(ledger)
    assert guessed.columns == [*ledger.columns, "category"] and guessed.where(F.col("category") == F.col("true_category")).count() > 550


def test_weights_are_those_of_the_library(spark, ledger):
    """The fit sees the same vectors as one put together with the library's own vector type."""
    from pyspark.ml.linalg import Vectors

    vocabulary = tx.numbered(tx.fit_idf(ledger))
    size = vocabulary.count()
    rows = tx._vectors(ledger, vocabulary, size, {"b": F.col(BEHAVIOUR[0])}, [F.col("id"), F.col("description"), F.col(BEHAVIOUR[0]).alias("b")]).collect()
    weights = {}
    for r in tx.tfidf(tx.description_counts(ledger), vocabulary).collect():
        weights.setdefault(r.description, {})[r.position] = r.weight
    assert len(rows) == 600
    for r in rows:
        assert r.x == Vectors.sparse(size + 1, {**weights.get(r.description, {}), size: r.b})


def test_no_python_and_no_vectors_where_it_scores(ledger):
    plan = tx.fit_categoriser(ledger, False, max_iter=3).transform(ledger)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan and "Vector" not in plan


def test_unknown_texts_and_one_class(spark, ledger):
    model = tx.fit_categoriser(ledger, False, max_iter=10)
    odd = spark.createDataFrame([("zzzz",), (None,), ("",), ("UBER TRIP",), ("UBER TRIP",)], "description string")
    out = model.transform(odd).collect()
    assert len(out) == 5 and len({r.category for r in out if r.description != "UBER TRIP"}) == 1
    single = tx.fit_categoriser(ledger.where("true_category = 'fees'"), False, max_iter=3)
    assert {r.category for r in single.transform(odd).collect()} == {"fees"}
