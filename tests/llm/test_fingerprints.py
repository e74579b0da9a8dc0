"""Fingerprints next to whole shingle sets."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gradus.llm import fingerprints
from tests.llm.fixture import documents, nothing, same_rows, strange, words


def shingle_set(text, width=5):
    w = words(text, lower=True)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def sketch(text, k=128, **more):
    return fingerprints.sketches(pa.array([text]), k=k, **more)[0]


def brute(rows):
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (-r[0], r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 2
        out.append((doc_id, text, text[: len(text) - n] + following[:n], following))
    for doc_id, text in rows:
        if doc_id is None:
            text = text or ""
            out.append((None, text, text[: len(text) - len(text) // 2], None))
    return out


@pytest.mark.parametrize("table,stretch,part", [(documents, 20_000, 1 << 22), (documents, 3, 64), (strange, 20_000, 1 << 22), (strange, 1, 16)])
def test_against_next(spark, monkeypatch, table, stretch, part):
    monkeypatch.setattr(fingerprints, "ROWS_PER_STRETCH", stretch)
    monkeypatch.setattr(fingerprints, "PART", part)
    docs = table(spark).repartition(4)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = fingerprints.against_next(docs).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    code = lambda t: fingerprints.written(sketch(t))
    same_rows([tuple(r)[:5] for r in got], [(d, len(t), digest(e), code(t), code(e)) for d, t, e, _ in want])
    exact = sorted(((d is not None, d), digest(e), likeness(shingle_set(t), shingle_set(e)), -1 if n is None else likeness(shingle_set(t), shingle_set(n)), len(t)) for d, t, e, n in want)
    found = sorted(((r.doc_id is not None, r.doc_id), r.edited_sha256, r.near_edited, -1 if r.near_next is None else r.near_next, r.n_chars) for r in got)
    for x, y in zip(found, exact):
        assert x[:2] == y[:2] and abs(x[2] - y[2]) < 0.2 and abs(x[3] - y[3]) < 0.2
        if x[4] < 300:  # the whole sets are in the fingerprints
            assert x == y


def test_one_document_is_next_to_itself(spark):
    row = fingerprints.against_next(spark.createDataFrame([(9, "a b c d e f g h")], "doc_id long, text string")).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a b c d a b c d"[:8] + b"a b c d"[:7]).hexdigest()


def test_estimates_of_large_sets():
    r = random.Random(5)
    a = [f"w{r.randrange(40_000)}" for _ in range(60_000)]
    b = a[20_000:] + [f"v{r.randrange(40_000)}" for _ in range(20_000)]
    x, y = " ".join(a), " ".join(b)
    sx, sy = shingle_set(x), shingle_set(y)
    k = 2_048
    fx, fy = sketch(x, k), sketch(y, k)
    assert len(fx) == k and abs(fingerprints.resemblance(fx, fy, k) - likeness(sx, sy)) < 0.05
    assert abs(fingerprints.containment(fx, fy, k) - len(sx & sy) / len(sx)) < 0.06
    assert abs(fingerprints.distinct(fx, k) / len(sx) - 1) < 0.1


def test_parts_make_the_same_sketch_as_the_whole():
    r = random.Random(6)
    text = "".join(r.choice(["a", "bb", "ccc", "Ü"]) + r.choice([" ", "\n", "  "]) for _ in range(3_000)) + "x" * 5_000 + " y"
    for part in (7, 100, 4_096):
        assert (sketch(text, part=part) == sketch(text)).all()
    assert (sketch("one two three", part=4) == sketch("one two three")).all()
    two = "p q r s t u v w"
    assert (fingerprints.merge(sketch(two), sketch(text)) == fingerprints.smallest(np.concatenate((sketch(two), sketch(text))), 128)).all()


def test_merged_groups(spark):
    docs = documents(spark)
    ids = fingerprints.fingerprints(docs)
    assert [(r.doc_id, r.n_chars) for r in ids.orderBy("doc_id").collect()] == sorted((r.doc_id, len(r.text or "")) for r in docs.collect())
    grouped = ids.withColumn("h", F.col("doc_id") % 3).withColumn("key", F.lit(1))
    got = {r.h: r for r in fingerprints.merged(grouped, ["h"]).withColumn("n", fingerprints.distinct_shingles(F.col("fingerprint"))).collect()}
    for h, row in got.items():
        union = np.unique(np.concatenate([sketch(r.text) for r in docs.collect() if r.doc_id % 3 == h]))[:128]
        assert row.fingerprint == fingerprints.written(union) and (fingerprints.read(row.fingerprint) == union).all()
        assert abs(row.n / fingerprints.distinct(union) - 1) < 1e-9
    assert fingerprints.merged(grouped, []).count() == 1
    assert fingerprints.merged(fingerprints.fingerprints(nothing(spark)), ["doc_id"]).count() == 0


def test_nothing(spark):
    assert fingerprints.against_next(nothing(spark)).count() == 0 and fingerprints.fingerprints(nothing(spark)).count() == 0
