"""Counts per pair of bins, and what follows from them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import joint, selection, woe

RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def book(spark):
    rows = []
    for i in range(900):
        u, v = RNG.uniform(), RNG.normal()
        y = int(RNG.uniform() < 0.1 + 0.5 * u)
        rows.append((float(u), float(u * 3 + 0.02 * v), float(v) if i % 7 else None, 1.0, "x" if i % 11 == 0 else str(round(v + u, 3)), None if i == 5 else y))
    return spark.createDataFrame(rows, "u double, twin double, v double, flat double, text string, y int").repartition(5)


NAMES = ["u", "twin", "v", "flat", "text"]


def test_cells_hold_every_row(spark, book):
    edges = {"u": [0.2, 0.5], "twin": [1.0], "v": [0.0], "flat": [], "text": [0.3, 0.9]}
    cells = joint.joint_bin_counts(book, edges, "y")
    per_pair = {(r.a, r.b): r.n for r in cells.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()}
    assert len(per_pair) == 15 and set(per_pair.values()) == {900}
    known = book.where("y is not null")
    want = {tuple(r) for r in woe.bin_counts(known, edges, "y").select("feature", "bin_index", "count", "goods", "bads").collect()}
    got = {tuple(r) for r in joint.counts_by_bin(joint.joint_bin_counts(known, edges, "y"), "y").collect()}
    assert got == want


def test_one_scan_gives_what_three_gave(spark, book):
    known = book.where("y is not null")
    bins, chosen = selection.fit_and_select(known, NAMES, "y")
    alone = woe.woe_fit(known, NAMES, "y")
    assert bins == alone and chosen == selection.select_features(known, alone, "y")
    assert "correlated" in chosen.reasons["twin"] + chosen.reasons.get("u", "")


def test_correlations_of_merged_bins(spark, book):
    known = book.where("y is not null")
    edges = woe.coarse_edges(known, NAMES)
    cells = joint.joint_bin_counts(known, edges, "y")
    bins = woe.woe_fit(known, NAMES, "y")
    assert any(len(bins.features[f].edges) < len(edges[f]) for f in NAMES)
    wide = woe.woe_transform(known, bins).select(*[f"woe_{f}" for f in NAMES]).toPandas()
    order = ["text", "u", "v", "twin", "flat"]
    got = {(r.a, r.b): r["corr"] for r in joint.correlations(cells, joint.bin_values(bins, edges), order).collect()}
    assert len(got) == 10
    for (a, b), r in got.items():
        assert order.index(a) < order.index(b)
        if "flat" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(wide[f"woe_{a}"], wide[f"woe_{b}"])[0, 1], abs=1e-9)


def test_cells_are_summed_before_the_shuffle(book):
    plan = joint.joint_bin_counts(book, {"u": [0.2], "v": [0.0]}, "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("HashAggregate") == 2


def test_a_task_hands_over_cells_not_rows_times_pairs(spark, book):
    """A row is not copied once per pair of features: what leaves a task is as long as its table of cells."""
    edges = {"u": [0.2, 0.5], "twin": [1.0], "v": [0.0], "flat": [], "text": [0.3, 0.9]}
    plan = joint.joint_bin_counts(book, edges, "y")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan

    # Every cell, against counts of rows one pair at a time, over several batches and partitions.
    many = book.unionByName(book).repartition(3)
    rows = many.collect()
    place = lambda f, x: -1 if x is None else sum(e < x for e in edges[f])
    number = lambda x: None if x == "x" or x is None else float(x)
    bins = [{**{f: place(f, number(r[f])) for f in NAMES}, "y": -1 if r.y is None else r.y} for r in rows]
    names, want = [*NAMES, "y"], {}
    for b in bins:
        for i, f in enumerate(names):
            for g in names[i + 1 :]:
                want[f, b[f], g, b[g]] = want.get((f, b[f], g, b[g]), 0) + 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = {(r.a, r.bin_a, r.b, r.bin_b): r.n for r in joint.joint_bin_counts(many, edges, "y").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


def test_nothing(spark, book):
    none = book.limit(0)
    edges = {"u": [0.5], "v": []}
    cells = joint.joint_bin_counts(none, edges, "y")
    assert cells.count() == 0
    assert [tuple(r) for r in joint.correlations(cells, [("u", 0, 1.0)], ["u", "v"]).collect()] == [("u", "v", None)]
    assert joint.correlations(cells, [("u", 0, 1.0)], ["u"]).count() == 0
