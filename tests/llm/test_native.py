"""Quality rules, exact duplicates and mixing next to plain Python."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from gradus.llm import exact_dedup, mixing, quality_rules
from tests.llm.fixture import documents, nothing, same_rows, strange, words


def squeezed(text):
    return b"".join(words(text))


@pytest.mark.parametrize("heavy", [2, 3, 4096])
def test_exact_groups_for_any_share(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    docs = documents(spark)
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[squeezed(text)].append((-len(text), doc_id))
    want = []
    for doc_id, text in rows:
        own = sorted(groups[squeezed(text)])
        want.append((doc_id, own[0][1], len(own), own[0][1] == doc_id, hashlib.sha256(squeezed(text)).hexdigest(), len(text)))
    same_rows(exact_dedup.exact_groups(docs).collect(), want)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if w[3])


def test_exact_dedup_keeps_one_of_rows_that_nothing_tells_apart(spark):
    kept = exact_dedup.deduplicate(strange(spark)).collect()
    assert sorted(squeezed(r.text) for r in kept) == sorted({squeezed(r.text) for r in strange(spark).collect()})
    assert sum(r.kept for r in exact_dedup.exact_groups(strange(spark)).collect()) == len(kept)
    assert all(r.doc_id is not None for r in kept)
    assert exact_dedup.exact_groups(nothing(spark)).count() == 0
    assert exact_dedup.deduplicate(nothing(spark)).count() == 0


def brute_targets(sizes):
    """Fill by weight, take off what is over, share it again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > 2 * sizes[s]]
        if not over:
            return {**full, **{s: level * weight[s] for s in rest}}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def test_targets(spark):
    for sizes in ({"a": 100, "b": 10, "c": 7, None: 3, "B": 1000}, {"a": 1}, {None: 5, "x": 0}, {"a": 0, "b": 0}, {str(i): i * i % 97 for i in range(30)}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        assert all(math.isclose(got[s], want[s], rel_tol=1e-12, abs_tol=1e-9) for s in want), (got, want)


def test_mix_is_systematic(spark):
    docs = documents(spark)
    first = mixing.copies(docs, carry=["doc_id", "source"]).collect()
    again = mixing.copies(docs.repartition(7), carry=["doc_id", "source"]).collect()
    same_rows([(r.row.doc_id, r.copies) for r in first], [(r.row.doc_id, r.copies) for r in again])
    assert len(first) == docs.count()
    by = defaultdict(list)
    for r in first:
        by[r.row.source].append(r)
    for rows in by.values():
        rate = rows[0].target / rows[0].source_size
        assert all(math.floor(rate) <= r.copies <= math.ceil(rate) for r in rows)
        assert abs(sum(r.copies for r in rows) - rate * len(rows)) < 1.001
        assert abs(sum(r.copies * r.size for r in rows) - rows[0].target) <= max(r.size for r in rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.row.doc_id: r.copies for r in first if r.copies})


def test_mix_of_odd_tables(spark):
    assert mixing.copies(strange(spark)).count() == strange(spark).count()
    assert mixing.mix(nothing(spark)).count() == 0


def brute_measures(text):
    w = [x.decode() for x in words(text)]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n, symbols = len(w), sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_measures(spark):
    docs = documents(spark)
    got = quality_rules.measured(docs).selectExpr("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    same_rows(got, [(r.doc_id, *brute_measures(r.text)) for r in docs.collect()])


def test_quota_is_the_binomial_one(spark):
    for n in (0, 1, 50, 200, 1_000, 5_000):
        for level in (0.05, 0.003):
            mass, most = 0.0, -1
            for i in range(n + 1):
                mass += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.03) + (n - i) * math.log(0.97))
                if mass > level:
                    break
                most = i
            from pyspark.sql import functions as F

            row = spark.range(1).select(quality_rules.allowed(F.lit(n).cast("long"), 0.03, F.lit(level)).alias("q")).first()
            assert row.q == most, (n, level)


def test_cutoffs_hold_their_risk_and_catch_the_rest(spark):
    clean, dirty = "plain words in a line of text that go on for a while " + "and on ", "#### $$ words &&& with *** symbols ||| %%% in between them all"
    rows = [(i, clean + f"n{i}" if i % 5 else dirty + f" n{i}", "en" if i % 2 else None, None, None, "x", "y", "z", None, "d", i) for i in range(2_000)]
    docs = spark.createDataFrame(rows, documents(spark).schema)
    labels = spark.createDataFrame([(i, 1 if i % 5 else 0) for i in range(2_000)] + [(None, 1), (5, 7)], "doc_id long, quality int")
    judged = quality_rules.judge(docs, labels).collect()
    assert {r.doc_id for r in judged if r.kept} == {i for i in range(2_000) if i % 5}
    few = quality_rules.judge(docs, labels.where("doc_id < 100")).collect()
    assert all(r.kept for r in few)  # nothing can be certified
    kept = quality_rules.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 1_600


def test_dropped_documents_are_worth_it(spark):
    """The symbols rule rejects all bad documents; capitals alone would lose good ones for bad ones that are gone already."""
    clean, loud, dirty = "plain words in a line of text that go on for a while ", "PLAIN WORDS in a line of text that go on for a while ", "#### $$ words &&& WITH *** symbols ||| %%% in between them all"
    text = lambda i: (dirty if i % 5 == 0 else loud if i % 200 == 1 else clean) + f" n{i}"
    rows = [(i, text(i), "en" if i % 2 else None, None, None, "x", "y", "z", None, "d", i) for i in range(2_000)]
    docs = spark.createDataFrame(rows, documents(spark).schema)
    labels = spark.createDataFrame([(i, 1 if i % 5 else 0) for i in range(2_000)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality_rules.accepted(docs, labels).collect()}
    assert kept == {i for i in range(2_000) if i % 5}


def test_rules_on_odd_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules.judge(strange(spark), labels).collect()
    assert len(got) == strange(spark).count() and all(r.kept == (not r.base_failed) for r in got)
    assert quality_rules.accepted(nothing(spark), labels).count() == 0
