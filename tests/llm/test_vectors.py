"""Hard negatives next to a search of everything."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.llm import hard_negatives
from tests.llm.fixture import same_rows

SCHEMA = "vec_id long, label int, embedding array<double>, is_anchor string, b int, rank string, dim string, positives int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], SCHEMA)


def brute(rows, is_anchor, positives=5, negatives=5, percent=80, scale=256):
    usable = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * scale) for x in v):
            continue
        entry = (label, [math.floor(scale * x) for x in v])
        packed = np.array(entry[1], dtype="<i2" if all(abs(x) <= 32_767 for x in entry[1]) else "<f8").tobytes()
        usable.setdefault((vec_id, len(v)), []).append((label, packed, entry[1]))
    usable = {k: min(v) for k, v in usable.items()}
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for (anchor, dim), (label, _, a) in usable.items():
        if not is_anchor(anchor):
            continue
        scored = [(-clip(sum(x * y for x, y in zip(a, v))), i, kind) for (i, d), (kind, _, v) in usable.items() if d == dim]
        for s, positive, _ in sorted(x for x in scored if x[2] == label and x[1] != anchor)[:positives]:
            fits = sorted((t, i) for t, i, kind in scored if kind != label and percent * -s <= 100 * -t <= 100 * -s)
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(fits[:negatives], 1)]
    return out


def vectors(seed, n, dim=8, labels=3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    rows = [(i, k := min(r.randrange(labels + 2), labels - 1), [c * 0.3 + r.gauss(0, 0.2) for c in centres[k]]) for i in range(n)]
    rows += [(n + i, r.randrange(labels), list(rows[i * 5][2])) for i in range(n // 8)]  # equal vectors, so ties
    return rows


ODD = [
    (None, 1, [0.1] * 8), (5_000, None, [0.1] * 8), (5_001, 1, None), (5_002, 1, [0.1] * 7 + [None]), (5_010, 1, [float("nan")] * 8), (5_020, 0, [float("inf")] + [0.0] * 7),
    (5_030, 0, [1e307] + [0.0] * 7), (5_040, 0, []), (5_041, 0, []), (5_042, 1, []), (5_050, 0, [0.5] * 3), (5_051, 0, [0.25] * 3), (5_052, 1, [0.24] * 3),
    (10, 0, [0.5] * 3), (20, 2, [0.3] * 8), (20, 1, [0.2] * 8), (20, 1, [0.2] * 8), (5_060, 1, [0.0] * 8), (5_070, 1, [-0.5] * 8),
]


@pytest.mark.parametrize("at_once,anchor_block,deepest,blocks", [(4_096, 1 << 15, 48, 64), (7, 5, 2, 3)])
def test_hard_negatives(spark, monkeypatch, at_once, anchor_block, deepest, blocks):
    for name, value in (("ROWS_AT_ONCE", at_once), ("ANCHORS_PER_BLOCK", anchor_block), ("LEAST_BLOCKS", blocks)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives.spanning_tree, "__defaults__", (deepest,))
    rows = vectors(1, 400) + ODD
    got = hard_negatives.hard_negatives(table(spark, rows).repartition(3), F.col("vec_id") % 10 == 0)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    same_rows(got.collect(), want)


def test_scores_beyond_a_double_and_a_long(spark):
    r = random.Random(4)
    rows = [(i, i % 2, [r.choice([1, 1e5, 3e9, 1e12, 1e300]) * r.random() for _ in range(3)]) for i in range(60)]
    rows += [(100 + i, i % 2, [3e5 + i / 256, 1e7, -2e6]) for i in range(20)]
    got = hard_negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 4 == 0, positives=3, negatives=2, percent=50)
    same_rows(got.collect(), brute(rows, lambda i: i % 4 == 0, 3, 2, 50))


def test_bounds_spare_scores():
    rows = np.array([v for _, _, v in vectors(2, 900, dim=4)]) * 256 // 1
    tree = rows[:60]
    parent, edges = hard_negatives.spanning_tree(tree)
    assert parent[0] == -1 and all(0 <= p < i for i, p in enumerate(parent) if i)
    best = {}

    def wanted(place, low, high):
        true = rows @ tree[place]
        assert (low <= true).all() and (true <= high).all()
        return high >= np.sort(true)[-5]

    def found(place, at, scores):
        best[place] = np.sort(scores)[-5:]

    scored = hard_negatives.descend(rows, tree, parent, edges, True, wanted, found)
    assert scored < 0.8 * rows.shape[0] * len(tree)
    assert all((best[i] == np.sort(rows @ tree[i])[-5:]).all() for i in range(len(tree)))


def test_depth_is_bounded():
    parent, _ = hard_negatives.spanning_tree(np.arange(200, dtype=float).reshape(-1, 1), deepest=5)
    depth = [0] * 200
    for i in range(1, 200):
        depth[i] = depth[parent[i]] + 1
    assert max(depth) == 5


def test_nothing_to_search(spark):
    assert hard_negatives.hard_negatives(table(spark, []), F.lit(True)).count() == 0
    assert hard_negatives.hard_negatives(table(spark, vectors(3, 20)), F.lit(False)).count() == 0
    assert hard_negatives.hard_negatives(table(spark, [(1, 1, [0.5])]), F.lit(True)).count() == 0
