"""Operators with numpy inside tasks next to plain Python."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from gradus.llm import bpe, components, exact_dedup, katz, line_dedup, minhash, nbsvm, repeats, token_files
from gradus.llm.text_queries import rank_file
from tests.llm.fixture import documents, nothing, same_rows, strange, words


# --- token files --------------------------------------------------------------------------
@pytest.mark.parametrize("block", [1, 3, 50, 1 << 18])
def test_token_counts_for_any_block(spark, block):
    docs = documents(spark).repartition(3)
    made = token_files.write_documents(docs, file_documents=9)
    got = token_files.named(token_files.scan(token_files.blocks_of_files(spark, made.path, block)), made)
    assert got.where("not finished").isEmpty()
    same_rows(got.select("doc_id", "n_tokens").collect(), [(r.doc_id, len(words(r.text))) for r in docs.collect()])
    files = defaultdict(list)
    for r in got.collect():
        files[r.file].append(r)
    for rows in files.values():
        rows.sort(key=lambda r: r.ordinal)
        assert [r.ordinal for r in rows] == list(range(len(rows)))
        assert all(a.start + a.n_tokens + 1 == b.start for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("block", [1, 2, 7, 100])
def test_flat_files(spark, tmp_path, block):
    tokens = [5, 9, 0, 0, 1, 1, 1, 1, 1, 1, 1, 0, 4]
    np.array(tokens, "<u2").tofile(tmp_path / "a.bin")
    (tmp_path / "empty.bin").write_bytes(b"")
    blocks = token_files.blocks_of_files(spark, str(tmp_path), block, token_bytes=2)
    got = sorted((r.ordinal, r.start, r.n_tokens, r.finished) for r in token_files.scan(blocks, end=0, token_bytes=2).collect())
    assert got == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 7, True), (3, 12, 1, False)]  # the last token has no end


def test_names_of_files_with_any_job_id(spark):
    names = spark.createDataFrame([(10, 7, 0, 2), (11, 7, 3, 2), (12, 7, 12, 2)], "doc_id long, part long, split long, ordinal long")
    file = "file:/x/part-00001-a/tokens-c5-1/part-00007-e875c865-c123-c464-a950-c12345678901-c003.txt"
    scanned = spark.createDataFrame([(file, 2, 0, 4, True)], "file string, ordinal long, start long, n_tokens long, finished boolean")
    assert [r.doc_id for r in token_files.named(scanned, token_files.FlatFiles("", names)).collect()] == [11]


def test_flat_files_of_odd_tables(spark):
    for docs in (strange(spark), nothing(spark), documents(spark).withColumn("ordinal", F.lit(1)).withColumn("part", F.lit(2))):
        made = token_files.write_documents(docs)
        got = token_files.named(token_files.scan(token_files.blocks_of_files(spark, made.path)), made)
        same_rows(got.select("doc_id", "n_tokens").collect(), [(r.doc_id, len(words(r.text))) for r in docs.collect()])


# --- repeats ------------------------------------------------------------------------------
def brute_repeats(rows, width):
    seen = Counter(tuple(w[i : i + width]) for _, w in rows for i in range(len(w) - width + 1))
    out = []
    for doc_id, w in rows:
        gone = {i + j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(width)}
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("width,seed,longest,broadcast", [(35, 8, 4_096, 500_000), (5, 2, 4_096, 0), (4, 4, 3, 500_000), (35, 20, 7, 0)])
def test_repeats(spark, monkeypatch, width, seed, longest, broadcast):
    monkeypatch.setattr(repeats, "LONGEST", longest)
    monkeypatch.setattr(repeats, "BROADCAST_SPANS", broadcast)
    docs = documents(spark)
    same_rows(repeats.remove_repeats(docs, width, seed).collect(), brute_repeats([(r.doc_id, words(r.text)) for r in docs.collect()], width))


def test_repeats_of_few_words(spark):
    r = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(r.choice("ab") for _ in range(r.randint(0, 60)))) for i in range(60)], "doc_id long, text string")
    same_rows(repeats.remove_repeats(docs, 9, 3).collect(), brute_repeats([(x.doc_id, words(x.text)) for x in docs.collect()], 9))


def test_repeats_of_odd_tables(spark):
    same_rows(repeats.remove_repeats(strange(spark)).collect(), brute_repeats([(r.doc_id, words(r.text)) for r in strange(spark).collect()], 35))
    assert repeats.remove_repeats(nothing(spark)).count() == 0


# --- lines --------------------------------------------------------------------------------
def brute_lines(rows, width=3):
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in order:
        lines = text.split("\n")
        for i in range(len(lines) - width + 1):
            if words("".join(lines[i : i + width])):
                first.setdefault(tuple(lines[i : i + width]), (doc_id, text, i))
    out = []
    for doc_id, text in rows:
        lines = text.split("\n")
        gone = {i + j for i in range(len(lines) - width + 1) if first.get(tuple(lines[i : i + width]), (doc_id, text, i)) != (doc_id, text, i) for j in range(width)}
        out.append((doc_id, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_lines(spark, monkeypatch, broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", broadcast)
    docs = documents(spark)
    got = line_dedup.remove_repeated_lines(docs).collect()
    same_rows(got, brute_lines([(r.doc_id, r.text or "") for r in docs.collect()]))
    assert any(r.n_removed for r in got)


def test_lines_of_odd_tables(spark):
    assert line_dedup.remove_repeated_lines(strange(spark)).count() == strange(spark).count()
    assert line_dedup.remove_repeated_lines(nothing(spark)).count() == 0


# --- near duplicates ----------------------------------------------------------------------
def brute_components(rows, width, percent):
    sets = {}
    for doc_id, text in rows:
        w = words(text, lower=True)
        sets[doc_id] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(d, len(sets[d]), find(d), find(d) == d) for d in sets]


def edited(seed):
    """A group around one text, from a word changed to half of them, and lone texts."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(120):
        w = list(base) if i % 4 else [f"{i}x{j}" for j in range(r.randint(1, 90))]
        for _ in range(r.randint(0, 8) if len(w) > 8 else 0):
            at = r.randrange(len(w))
            w[at : at + 1] = [] if r.random() < 0.4 else [r.choice(["the", "a", f"n{r.randrange(50)}"])]
        out.append((1_000 - 3 * i, " ".join(w)))
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups(spark, width):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()] + edited(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same_rows(minhash.near_groups(docs, width, 80).collect(), brute_components(rows, width, 80))


def test_near_groups_of_odd_tables(spark):
    docs = strange(spark)
    got = minhash.near_groups(docs).collect()
    assert len(got) == docs.count()
    assert all(r.kept for r in got if r.doc_id is None or r.n_shingles == 0)
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert minhash.near_groups(nothing(spark)).count() == 0 and minhash.deduplicate(nothing(spark)).count() == 0


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] + [(5, 5), (None, 3), (9, 8), (8, 9)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    same_rows(components.components(spark.createDataFrame(links, "a long, b long")).collect(), [(x, find(x)) for x in root])


# --- classifier ---------------------------------------------------------------------------
def test_descent_solves_the_hinge_loss():
    r = np.random.default_rng(1)
    rows = [np.sort(r.choice(40, 12, replace=False)) for _ in range(120)]
    signs = np.where(np.array([x[0] % 2 for x in rows]) == 1, 1.0, -1.0)
    ratios = r.normal(size=40)
    weights, bias = nbsvm.descend(rows, signs, ratios, rounds=400)
    units = np.zeros((120, 41))
    for i, x in enumerate(rows):
        units[i, x] = ratios[x] / np.linalg.norm(ratios[x])
    units[:, 40] = 1.0
    found = np.append(weights / ratios, bias)

    def loss(w):
        return 0.5 * w @ w + np.maximum(0, 1 - signs * (units @ w)).sum()

    assert all(loss(found) <= loss(found + 0.01 * r.normal(size=41)) + 1e-3 for _ in range(200))


def test_classifier_on_held_out_texts(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        rows.append((i, " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + ("!!" if bad and r.random() < 0.5 else "") for _ in range(r.randint(5, 60))), "x", 0.5))
        labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame([*rows, (None, None, None, None), (601, "", None, None)], "doc_id long, text string, label string, score double")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = nbsvm.scores(docs, spark.createDataFrame([*labels, (None, 0), (2, 5)], "doc_id long, quality int"), held).collect()
    assert len(got) == 602 and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    out = [x for x in got if x.held_out and x.doc_id < 600]
    assert len(out) > 100 and sum(x.predicted == (x.doc_id % 3 != 0) for x in out) >= 0.97 * len(out)


def test_classifier_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    assert {r.score for r in nbsvm.scores(strange(spark), none, held).collect()} == {0.5}
    assert nbsvm.scores(nothing(spark), none, held).count() == 0


# --- encoding -----------------------------------------------------------------------------
def test_bpe_is_that_of_the_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file().splitlines())}
    peer = tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = documents(spark)
    coded = bpe.encode(docs.select("doc_id", "text"), rank_file(), public_tokenizers.PATTERN)
    want = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in coded.collect()} == {d: peer.encode_ordinary(t) for d, t in want.items()}
    back = bpe.decode(coded, rank_file(), public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == want
    assert bpe.round_trip(nothing(spark).select("doc_id", "text"), rank_file(), public_tokenizers.PATTERN).count() == 0


def test_tree_and_runs_of_space():
    encoder = bpe.Encoder(rank_file(), public_tokenizers.PATTERN)
    peer = tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    r = random.Random(6)
    for _ in range(300):
        raw = "".join(r.choice(["ab", "a", "the", "===", " "]) for _ in range(r.randint(20, 200))).encode()
        assert encoder.tree(raw) == encoder.merge(raw) == encoder._merge_long(raw)
    for _ in range(3_000):
        text = "".join(r.choice(["a", " ", "  ", "\n", "\t", "b.", "'s", "é", " x", " ", "1", "🙂"]) for _ in range(r.randint(0, 12)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == peer.encode_ordinary(text), repr(text)
    long = "a" * 20_000
    assert np.frombuffer(encoder.encode(long), "<u4").tolist() == peer.encode_ordinary(long)


def test_cut_at_spaces_keeps_the_matches():
    encoder = bpe.Encoder(rank_file(), public_tokenizers.PATTERN)
    encoder.pieces = bpe._Known(lambda piece: piece.encode() + b"|", 1_000)
    r = random.Random(7)
    for text in ["a ", "a\t ", "a\n ", "\t ", " ", "a  ", " a", "\t b ", *("".join(r.choice(["a", " ", "\n", "\t", "b.", "'s", "é", " x", "\u00a0", "1"]) for _ in range(r.randint(0, 9))) for _ in range(5_000))]:
        assert encoder.encode(text) == b"".join(x.encode() + b"|" for x in encoder.pattern.findall(text)), repr(text)


def test_columns_of_like_names(spark):
    docs = documents(spark).select("doc_id", "text", F.lit(1).alias("ids"), F.lit(2).alias("Decoded"), F.lit(3).alias("_gone_id"), F.lit(4).alias("_odd_id"), F.lit(5).alias("odd name"))
    coded = bpe.round_trip(docs, rank_file(), public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "_gone_id", "_odd_id", "odd name", "ids", "decoded"]
    want = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: bytes(r.decoded).decode() for r in coded.collect()} == want
    for gather in (minhash.deduplicate, exact_dedup.deduplicate):
        kept = gather(docs)
        assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
        odd = gather(docs.union(docs.limit(5)).withColumn("doc_id", F.when(F.col("doc_id") > 50, F.col("doc_id"))))
        assert odd.columns == docs.columns and odd.count() > 0


# --- language model -----------------------------------------------------------------------
def brute_katz(rows):
    end, start, top = b"\0end", b"\0start", katz.DISCOUNTED
    texts = [(d, h, words(t, lower=True) + [end]) for d, h, t in rows]
    counts = Counter(w for _, h, ws in texts if not h for w in ws)
    n, v = sum(counts.values()), len(counts)

    def factors(table):
        having = Counter(table.values())
        out = katz.discounts(np.array([having[r] for r in range(top + 2)], float))
        return lambda r: r * (out[r] if r <= top else 1.0)

    one = factors(counts)
    taken = sum(map(one, counts.values())) / n if n else 0
    scale = min(1.0, n / (n + 1) / taken) if taken else 1.0
    word = lambda w: one(counts[w]) / n * scale if w in counts else 1 - scale * taken
    pairs = Counter()
    for _, h, ws in texts:
        for a, b in zip([start, *ws], ws) if not h else ():
            pairs[a, b] += 1
    two = factors(pairs)
    history = {**counts, start: sum(not h for _, h, _ in texts)}
    own, lower = Counter(), Counter()
    for (a, b), c in pairs.items():
        own[a] += two(c) / max(history[a], 1)
        lower[a] += word(b)
    scales = {a: min(1.0, history[a] / (history[a] + 1) / own[a]) if own[a] else 1.0 for a in history}
    back = {a: (1 - scales[a] * own[a]) / (1 - lower[a]) for a in history}

    def probability(a, b):
        if (a, b) in pairs:
            return two(pairs[a, b]) / history[a] * scales[a]
        return back.get(a, 1.0) * word(b)

    for a in history if n else ():
        assert math.isclose(sum(probability(a, b) for b in counts) + probability(a, b"\0unknown"), 1.0, rel_tol=1e-9)
    out = []
    for d, h, ws in texts:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        out.append((d, h, len(ws), sum(w in counts for w in ws), n, base, sum(math.log10(probability(a, b)) for a, b in zip([start, *ws], ws))))
    return out


@pytest.mark.parametrize("sent_share,bucket_bytes", [(1e-5, 48_000_000), (1e-6, 2_000), (0.005, 2_000), (0.2, 5_000), (1.0, 700)])
def test_katz_models_all_pairs_whatever_is_sent(spark, monkeypatch, sent_share, bucket_bytes):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 500 if bucket_bytes < 10_000 else 3_000_000)
    docs = documents(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    want = {r[0]: r for r in brute_katz([tuple(r) for r in docs.select("doc_id", held, "text").collect()])}
    got = katz.scores(docs, held, bucket_bytes, sent_share).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert tuple(r)[:5] == w[:5] and math.isclose(r.base_score, w[5], rel_tol=1e-9) and math.isclose(r.score, w[6], rel_tol=1e-9), (r, w)


def test_katz_of_odd_tables(spark):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = katz.scores(strange(spark), held).collect()
    assert len(got) == strange(spark).count() and sum(r.doc_id is None for r in got) == 3
    assert katz.scores(nothing(spark), held).count() == 0
    untrained = katz.scores(strange(spark), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in untrained)


def test_bpe_remembers_the_stretches_of_many_texts():
    """Words that come back after 150,000 others are not split and looked up anew; the ids are the same."""
    import base64

    from gradus.llm import bpe

    ranks = b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256))
    encoder, words = bpe.Encoder(ranks, r" ?\S+|\s+"), [f"w{i}" for i in range(150_000)]
    texts = [" ".join(words[k::10]) for k in range(10)]
    first, anew, plain = [encoder.encode(t) for t in texts], [], encoder.stretches.encode
    encoder.stretches.encode = lambda rest: anew.append(rest) or plain(rest)
    assert [encoder.encode(t) for t in texts] == first and not anew
    assert [encoder.decode(ids).decode() for ids in first] == texts
