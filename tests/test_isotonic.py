"""Pooled blocks and the curve through them, next to the library's isotonic regression."""

import random

import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from gradus.operators import fitting as fit
from gradus.operators import isotonic as iso
from gradus.operators.ordering import score_table
from gradus.operators.scoring import IsotonicCurve, IsotonicTable, curve_frame, curve_of, step_curve


@pytest.fixture(scope="module")
def scores(spark):
    r = random.Random(2)
    rows = [(p := round(r.random(), 3), int(r.random() < p * p)) for _ in range(4_000)]
    rows += [(None, 1), (float("nan"), 0), (0.5, 0), (0.5, 1)]
    return spark.createDataFrame(rows, "p double, y int")


def library(scores):
    table = score_table(scores.where("p is not null and not isnan(p)"), "p", "y")
    points = table.select("p", (F.col("bads") / F.col("n")).alias("rate"), F.col("n").cast("double").alias("w"))
    model = IsotonicRegression(featuresCol="p", labelCol="rate", weightCol="w").fit(points)
    return IsotonicCurve(list(map(float, model.boundaries)), list(map(float, model.predictions)))


@pytest.mark.parametrize("rows_per_range,fan_in", [(1_000_000, 16), (60, 3), (7, 2)])
def test_blocks_are_those_of_the_library(spark, scores, rows_per_range, fan_in):
    blocks = sorted(map(tuple, iso.pooled_blocks(score_table(scores, "p", "y"), rows_per_range, fan_in).collect()))
    rates = [b / n for _, _, n, b in blocks]
    assert rates == sorted(set(rates)) and sum(n for _, _, n, _ in blocks) == 4_002
    grid = spark.createDataFrame([(i / 997 * 1.2 - 0.1,) for i in range(998)], "p double")
    curve = step_curve(iso.curve_points(spark.createDataFrame(blocks, "lo double, hi double, n long, bads long")))
    mine, theirs = (c.add(grid, "p", "q").orderBy("p").collect() for c in (curve, library(scores)))
    assert [r.q for r in mine] == pytest.approx([r.q for r in theirs], abs=1e-12)


@pytest.mark.parametrize("stretches", [1, 4, 300])
def test_a_table_looks_up_as_literals_do(spark, scores, stretches):
    curve = fit.fit_calibrator(scores, "p", "y")
    assert isinstance(curve, IsotonicCurve)
    points = curve_frame(spark, curve).select("x", "y")
    table = IsotonicTable(points, stretches)
    assert isinstance(step_curve(points, 3), IsotonicTable) and curve_of(curve_frame(spark, table)) == curve
    grid = spark.createDataFrame([(i / 499 * 1.4 - 0.2,) for i in range(500)] + [(x,) for x in curve.boundaries], "p double")
    found = table.add(grid, "p", "q")
    assert found.columns == ["p", "q"] and (stretches == 1 or "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString())
    same = lambda df: sorted(map(tuple, df.collect()))
    assert [q for _, q in same(found)] == pytest.approx([q for _, q in same(curve.add(grid, "p", "q"))], abs=1e-12)


def test_one_score_and_none(spark):
    one = spark.createDataFrame([(0.3, 1, 0), (0.3, 0, 0)], "p double, y int, z int")
    assert fit.fit_calibrator(one, "p", "y") == IsotonicCurve([0.3], [0.5])
    assert iso.pooled_blocks(score_table(one.limit(0), "p", "y")).count() == 0
