"""Collocations next to counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gradus.llm import collocations
from tests.llm.fixture import documents, nothing, same_rows, strange

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, inside=50, first=2_000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        own = counts[lang or "und"] if lang != "" else counts[""]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                own.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    held[p[i : i + m]] = max(held[p[i : i + m]], a)
        found = []
        for p, a in candidates.items():
            if p in held and 100 * held[p] >= inside * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:first], 1)]
    return out


def of(docs):
    return [(r.lang, r.text) for r in docs.collect()]


@pytest.mark.parametrize("longest,least,head,dense,part,bits", [(3, 10, 1 << 15, 1 << 12, 1 << 23, 27), (3, 4, 40, 1, 300, 3), (2, 3, 16, 1, 1_000, 27), (5, 3, 64, 2, 5_000, 5)])
def test_collocations(spark, monkeypatch, longest, least, head, dense, part, bits):
    for name, value in (("HEAD", head), ("SIDE", min(head, 8) if head < 100 else 1 << 9), ("DENSE", dense), ("SLICE", part), ("BITMAP_BITS", max(bits, 16))):
        monkeypatch.setattr(collocations, name, value)
    r = random.Random(7)
    vocabulary = ["the", "Of", "und", "New", "york", "city", "x.y", "é", "漢字", "a-b"] + [f"w{i}" for i in range(30)]
    more = [(None if i % 5 == 0 else ["en", "de", "und"][i % 3], "".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\t", ", ", "\n", "  ", "! "]) for _ in range(120)) + "New York City. " * (i % 3)) for i in range(40)]
    docs = documents(spark).select("lang", "text").union(spark.createDataFrame(more, "lang string, text string")).repartition(3)
    want = brute(of(docs), longest, least)
    assert len(want) > 3
    same_rows(collocations.collocations(docs, longest, least).collect(), want)


@pytest.mark.parametrize("first", [1, 5])
def test_ties_and_the_first(spark, first):
    docs = spark.createDataFrame([("en", "b a. c d. e f. g h i. g h. j. j k")] * 12 + [("", "p q"), (None, "p q")] * 11, "lang string, text string")
    same_rows(collocations.collocations(docs, first=first).collect(), brute(of(docs), first=first))


def test_two_words_of_one_key(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "ab cd. ab cd. ab xy")] * 10, "lang string, text string")
    real, seeds = collocations.word_counts, []

    def clashing(named, seed, least):
        seeds.append(seed)
        counted = real(named, seed, least)
        return counted if seed else counted.selectExpr("key", "lang", "word", "n", "true as clash")

    monkeypatch.setattr(collocations, "word_counts", clashing)
    same_rows(collocations.collocations(docs).collect(), brute(of(docs)))
    assert seeds == [0, 1]


def test_counts_beyond_64_bits(spark):
    row = spark.createDataFrame([(3_000_000_000_000, 4_000_000_000_000, 5_000_000_000_001)], "a long, l long, r long")
    assert row.select(collocations.score(row.a, row.l, row.r).alias("s")).first().s == 1_000_000 * 3_000_000_000_000**2 // (4_000_000_000_000 * 5_000_000_000_001)


def test_tiles_count_every_pair():
    r = np.random.default_rng(1)
    left, right = r.zipf(1.3, 50_000) % 3_000 - 1, r.zipf(1.3, 50_000) % 3_000 - 1
    tiles = collocations.Tiles()
    taken = tiles.add(left, right) | False
    counts = Counter(zip(left[~taken].tolist(), right[~taken].tolist()))
    assert taken.any() and not taken.all()
    for x, y, n in tiles.cells():
        counts.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    assert counts == Counter(zip(left.tolist(), right.tolist()))


def test_odd_tables(spark):
    same_rows(collocations.collocations(strange(spark)).collect(), brute(of(strange(spark))))
    assert collocations.collocations(nothing(spark)).count() == 0
    long = spark.createDataFrame([("en", "x" * 300_000 + " y. " + "loop " * 400_000), ("en", " ,,\n\t")], "lang string, text string")
    same_rows(collocations.collocations(long).collect(), brute(of(long)))
