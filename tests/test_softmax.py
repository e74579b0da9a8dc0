"""The fit on rows that share texts, next to the library's on one vector a row."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from gradus.operators import softmax as sm
from gradus.operators import text as tx
from gradus.operators.ledger import BEHAVIOUR

TEXTS = {None: {}, "nothing known": {}, "a": {0: 0.6, 2: 0.8}, "b": {1: 1.0}, "c": {0: 0.5, 1: 0.5, 4: 0.7}, "hot": {2: 0.3, 4: 0.9}}
SIZE, WIDTH, CLASSES = 6, 2, 3  # position 3 and 5 are in no text


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    made = []
    for i in range(700):
        text = "hot" if i % 2 else r.choice(list(TEXTS))
        x = [r.gauss(0, 1), r.gauss(0, 1)]
        made.append((i, text, int(np.argmax([x[0] + r.gauss(0, 1), x[1] + r.gauss(0, 1), (text == "b") + r.gauss(0, 1)])), *x))
    made += [(700, "a", 1, None, 0.5)] + [made[0]] * 20  # a null counts as 0; rows may come twice
    return spark.createDataFrame(made, "id long, description string, label int, u double, v double").repartition(3)


@pytest.fixture(scope="module")
def blocks(spark, rows):
    cells = spark.createDataFrame([(t, list(c), list(c.values())) for t, c in TEXTS.items() if c], "described string, positions array<int>, weights array<double>")
    return sm.text_blocks(rows, cells, F.col("label"), [F.col("u"), F.col("v")], block_rows=64)


def dense(rows):
    held = rows.collect()
    x = np.zeros((len(held), SIZE + WIDTH))
    for i, r in enumerate(held):
        for p, w in TEXTS[r.description].items():
            x[i, p] = w
        x[i, SIZE:] = [r.u or 0.0, r.v or 0.0]
    return x, np.array([r.label for r in held])


def test_loss_and_gradient_are_those_of_plain_rows(rows, blocks):
    written, n = blocks
    x, y = dense(rows)
    w = np.random.default_rng(1).normal(size=(CLASSES, SIZE + WIDTH + 1))
    z = x @ w[:, :-1].T + w[:, -1]
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    want = p - np.eye(CLASSES)[y]
    loss, gradient = sm.summed_over(written, w, WIDTH)
    assert n == len(y) == 721 and written.count() > 5  # the hot text is dealt to several blocks
    assert loss == pytest.approx(-np.log(p[np.arange(n), y]).sum(), rel=1e-12)
    np.testing.assert_allclose(gradient, np.c_[want.T @ x, want.sum(0)], atol=1e-9)


def test_weights_are_those_of_the_library(spark, rows, blocks):
    written, n = blocks
    x, y = dense(rows)
    fitted = spark.createDataFrame([(float(label), Vectors.dense(v)) for label, v in zip(y, x)], ["label", "x"])
    library = LogisticRegression(featuresCol="x", labelCol="label", family="multinomial", regParam=0.01, standardization=False, tol=1e-12, maxIter=500).fit(fitted)
    found = {}
    for name, tol in (("close", 1e-13), ("usual", 1e-6)):
        real = sm.minimised
        sm.minimised = lambda e, s, m, real=real, tol=tol: real(e, s, m, tol)
        try:
            found[name] = sm.fit_softmax(written, n, x.std(0), x.mean(0), WIDTH, np.bincount(y) / n, 0.01, 500)
        finally:
            sm.minimised = real
    for name, close in (("close", 1e-5), ("usual", 2e-2)):
        weights, intercepts, rounds = found[name]
        np.testing.assert_allclose(weights, library.coefficientMatrix.toArray(), atol=close)
        np.testing.assert_allclose(intercepts, library.interceptVector.toArray(), atol=close)
        assert 0 < rounds < 500
    assert not found["close"][0][:, [3, 5]].any()


def test_a_row_carries_no_vector_of_its_text(spark):
    """Cells written grow with distinct texts, not with rows."""
    cells = spark.createDataFrame([("x", list(range(500)), [0.1] * 500)], "described string, positions array<int>, weights array<double>")
    many = spark.range(4000).select(F.lit("x").alias("description"), (F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("u"))
    written, n = sm.text_blocks(many, cells, F.col("label"), [F.col("u")], block_rows=1000)
    held = written.select((F.octet_length("positions") / 4).alias("cells"), (F.octet_length("labels") / 4).alias("rows")).collect()
    assert n == sum(r.rows for r in held) == 4000 and sum(r.cells for r in held) <= 500 * 16


def test_what_is_refused(spark):
    cells = spark.createDataFrame([], "described string, positions array<int>, weights array<double>")
    odd = spark.createDataFrame([("a", None, 1.0)], "description string, label int, u double")
    with pytest.raises(Exception, match="without a class"):
        sm.text_blocks(odd, cells, F.col("label"), [F.col("u")])
    odd = spark.createDataFrame([("a", 0, float("nan"))], "description string, label int, u double")
    with pytest.raises(Exception, match="NaN"):
        sm.text_blocks(odd, cells, F.col("label"), [F.col("u")])


def test_least_point():
    a = np.diag([1.0, 30.0, 900.0])
    x, rounds = sm.minimised(lambda v: (0.5 * v @ a @ v - v.sum() + 2.0, a @ v - 1.0), np.zeros(3), 100, 1e-14)
    np.testing.assert_allclose(x, [1.0, 1 / 30, 1 / 900], atol=1e-6)
    assert rounds < 100
    assert sm.minimised(lambda v: (0.5 * v @ a @ v - v.sum() + 2.0, a @ v - 1.0), np.zeros(3), 2)[1] == 2


def test_hybrid_fit_next_to_one_vector_a_row(spark):
    """fit_categoriser with behaviour finds the weights that the library finds on whole vectors."""
    r = random.Random(8)
    made = [(f"{r.choice(['TESCO', 'ALDI', 'UBER'])} {r.randrange(4)}", r.choice("ab"), *[r.gauss(0, 1) for _ in BEHAVIOUR[:-1]], 1.0) for _ in range(300)]
    train = spark.createDataFrame(made, "description string, true_category string, " + ", ".join(f"{c} double" for c in BEHAVIOUR))
    model = tx.fit_categoriser(train, True, c=0.05)
    vocabulary = tx.numbered(tx.fit_idf(train))
    size = vocabulary.count()
    scaled = {c: (F.col(c) - F.lit(m)) * F.lit(1.0 / d if d else 0.0) for c, (m, d) in model.scaler.items()}
    vectors = tx._vectors(train, vocabulary, size, scaled, [(F.col("true_category") == "b").cast("double").alias("label")])
    library = LogisticRegression(featuresCol="x", labelCol="label", family="multinomial", regParam=1 / (0.05 * 300), standardization=False, tol=1e-10).fit(vectors)
    want = library.coefficientMatrix.toArray()
    at = {g.gram: g.position for g in vocabulary.collect()}
    for g in model.grams.collect():
        np.testing.assert_allclose(g.weights, want[:, at[g.gram]], atol=3e-3)
    for i, c in enumerate(BEHAVIOUR):
        np.testing.assert_allclose(model.behaviour[c], want[:, size + i], atol=3e-3)
    assert model.behaviour[BEHAVIOUR[-1]] == [0.0, 0.0]  # it never varies


def test_a_row_with_a_missing_value_keeps_its_place(spark):
    made = [("UBER", "t", *[float(i)] * len(BEHAVIOUR)) for i in range(9)] + [("ALDI", "g", *[float(i)] * len(BEHAVIOUR)) for i in range(9)]
    schema = "description string, true_category string, " + ", ".join(f"{c} double" for c in BEHAVIOUR)
    model = tx.fit_categoriser(spark.createDataFrame(made, schema), True)
    odd = spark.createDataFrame([("UBER", "t", *[1.0] * len(BEHAVIOUR)), ("UBER", "t", None, *[1.0] * (len(BEHAVIOUR) - 1)), (None, "t", *[1.0] * len(BEHAVIOUR))], schema)
    got = model.transform(odd)
    assert got.columns == [*odd.columns, "category"]
    assert sorted((r.description or "", r[BEHAVIOUR[0]] is None, r.category is None) for r in got.collect()) == [("", False, False), ("UBER", False, False), ("UBER", True, True)]
