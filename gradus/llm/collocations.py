"""Phrases whose words occur together more often than apart, by direct-address tiles.

A word is known by a 64-bit key of its language and bytes.  Words that occur often enough are
ranked by frequency.  Ranks of two neighbours address a cell of a table that is cut into
square tiles: within a task, a tile that many pairs fall into is counted by ``bincount`` into
a dense array, the others are sorted codes with counts.  Pairs that occur often enough are
ranked in turn and take the place of the left word, which counts phrases of one word more, and
so on.  Spark adds up what the tasks have counted.

Every task is sent two things of fixed size at most: the first ``HEAD`` ranks, and a bitmap of
the keys of all phrases that are frequent enough, which spares the others and never loses one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.llm.kernels import mixed, slices, spans, utf8, word_hashes
from gradus.llm.workers import in_arrow
from gradus.sources.tables import materialise

#: Ranks that have tiles, and ranks along one side of a tile.
HEAD, SIDE = 1 << 15, 1 << 9
#: Occurrences in one slice of texts that make a tile dense, and dense tiles of a task at most.
DENSE, TILES = 1 << 10, 24
#: Bits of the bitmap at most (16 MB), and bits for each key as long as there are fewer.
BITMAP_BITS, BITS_PER_KEY = 27, 16
#: Bytes of texts that are counted at a time.
SLICE = 1 << 20

_CUT = np.zeros(256, dtype=bool)
_CUT[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GAP = _CUT.copy()
_GAP[[0x20, 0x09]] = True
_ODD = np.uint64(0x9FB21C651E98DF25)
_UNKNOWN = "und"


# --- words of texts -----------------------------------------------------------------------
def _base(seed: int) -> np.uint64:
    return mixed(np.array([2 * seed + 1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0] | np.uint64(1)


def language_key(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


class Words:
    """Keys of the words of some texts, and which of them go on in the same piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array, seed: int):
        self.data, offsets = utf8(texts, lower=True)
        self.starts, self.ends, first = spans(self.data, offsets, _GAP)
        self.langs = langs.to_pylist()
        self.sizes = np.diff(first)
        salts = np.array([language_key(x) for x in self.langs], dtype=np.uint64)
        with np.errstate(over="ignore"):
            self.keys = mixed(word_hashes(self.data, self.starts, self.ends, _GAP, _base(seed)) + np.repeat(salts, self.sizes))
        piece = np.searchsorted(np.flatnonzero(_CUT[self.data]), self.starts)
        self.goes_on = np.append(piece[1:] == piece[:-1], False)[: len(piece)]
        borders = first[1:-1]
        self.goes_on[borders[(borders > 0)] - 1] = False


def _sliced(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Words]:
    for batch in batches:
        _, offsets = utf8(batch.column("text"))
        for lo, hi in slices(offsets, SLICE):
            part = batch.slice(lo, hi - lo)
            yield Words(part.column("lang"), part.column("text"), seed)


def word_counts(docs: DataFrame, seed: int, least: int) -> DataFrame:
    """Words that occur ``least`` times in their language: key, lang, word, n; and each language's total, without word.

    Two words of one key are kept whatever their count, marked by ``clash``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _sliced(batches, seed):
            keys, at, n = np.unique(some.keys, return_index=True, return_counts=True)
            raw, bounds = some.data.tobytes(), np.cumsum(some.sizes)
            text = np.searchsorted(bounds, at, side="right").tolist()
            found = [raw[s:e] for s, e in zip(some.starts[at].tolist(), some.ends[at].tolist())]
            totals: dict[str, int] = {}
            for lang, size in zip(some.langs, some.sizes.tolist()):
                totals[lang] = totals.get(lang, 0) + size
            cells = [
                pa.array([*keys.view(np.int64).tolist(), *[0] * len(totals)], pa.int64()),
                pa.array([*[some.langs[t] for t in text], *totals], pa.string()),
                pa.array([*found, *[None] * len(totals)], pa.binary()).cast(pa.string()),
                pa.array([*n.tolist(), *totals.values()], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(cells, names=["key", "lang", "word", "n"])

    rows = in_arrow(docs, run, "key long, lang string, word string, n long")
    whole = F.when(F.col("word").isNull(), F.col("lang"))
    counted = rows.groupBy("key", whole.alias("whole")).agg(
        F.sum("n").alias("n"), F.min("lang").alias("lang"), F.min("word").alias("word"), ((F.min("lang") != F.max("lang")) | (F.min("word") != F.max("word"))).alias("clash")
    )
    return counted.where((F.col("n") >= least) | F.col("word").isNull() | F.col("clash")).select("key", "lang", "word", "n", F.coalesce("clash", F.lit(False)).alias("clash"))


# --- what tasks are sent ------------------------------------------------------------------
class Level:
    """Phrases of one length that are frequent enough, in bounded size."""

    def __init__(self, bits: int, bitmap: np.ndarray, head: np.ndarray, hashes: np.ndarray):
        self.bits, self.bitmap = bits, bitmap
        #: Keys of the words of the first phrases, a row each by rank; ranks by hash.
        self.head, self.order = head, np.argsort(hashes, kind="stable")
        self.sorted = hashes[self.order]

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes & np.uint64((1 << self.bits) - 1)
        return ((self.bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)

    def ranks(self, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Rank of each phrase (its hash and the keys of its words), -1 for those beyond."""
        if not len(self.sorted):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        rank = self.order[at].astype(np.int64)
        rank[(self.head[rank] != words).any(axis=1)] = -1
        return rank


def level_of(counted: DataFrame, words: list[str]) -> Level:
    """From a written table of phrases: ``hash``, ``n`` and the keys ``words``."""
    bits = min(BITMAP_BITS, max(16, math.ceil(math.log2(max(counted.count(), 1) * BITS_PER_KEY))))
    bit = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    parts = counted.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap"))
    size = 4_096  # bytes of one of Spark's bitmaps
    bitmap = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in parts.toLocalIterator():
        lo = (row["part"] - 1) * size
        bitmap[lo : lo + size] = np.frombuffer(row["bitmap"], np.uint8)
    first = counted.orderBy(F.col("n").desc(), *words).limit(HEAD).select("hash", *words).toArrow()
    columns = [first.column(c).to_numpy().view(np.uint64) for c in ("hash", *words)]
    head = np.stack(columns[1:], axis=1) if len(first) else np.zeros((0, len(words)), np.uint64)
    return Level(bits, bitmap, head, columns[0])


# --- phrases of texts ---------------------------------------------------------------------
class Tiles:
    """Counts of pairs of ranks in the dense tiles of one task."""

    def __init__(self) -> None:
        self.side = -(-HEAD // SIDE)
        self.dense: dict[int, np.ndarray] = {}

    def add(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Count pairs in tiles that many of these fall into; which pairs that were."""
        tile = np.where((left >= 0) & (right >= 0), left // SIDE * self.side + right // SIDE, -1)
        hits = np.bincount(tile[tile >= 0], minlength=self.side * self.side)
        wanted = np.zeros(len(hits) + 1, dtype=bool)
        for t in np.argsort(-hits, kind="stable")[:TILES].tolist():
            if t in self.dense or (hits[t] >= DENSE and len(self.dense) < TILES):
                wanted[t] = True
        taken = wanted[tile]
        if taken.any():
            code = (left[taken] % SIDE) * SIDE + right[taken] % SIDE
            own = tile[taken]
            order = np.argsort(own, kind="stable")
            own, code = own[order], code[order]
            edges = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)]):
                self.dense.setdefault(int(own[a]), np.zeros(SIDE * SIDE, dtype=np.int64))[:] += np.bincount(code[a:b], minlength=SIDE * SIDE)
        return taken

    def cells(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Left ranks, right ranks and counts of each dense tile."""
        for tile, counts in self.dense.items():
            code = np.flatnonzero(counts)
            yield tile // self.side * SIDE + code // SIDE, tile % self.side * SIDE + code % SIDE, counts[code]


def phrase_hash(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(left * _ODD + word)


def phrase_counts(docs: DataFrame, seed: int, levels: list[Level], least: int) -> DataFrame:
    """Phrases of ``len(levels) + 1`` words that occur ``least`` times: keys w0, w1, ..., their hash, and n.

    ``levels`` are the frequent words, the frequent pairs and so on.
    """
    length = len(levels) + 1
    names = [f"w{i}" for i in range(length)]
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def rows(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        value = words[:, 0]
        for i in range(1, length):
            value = phrase_hash(value, words[:, i])
        cells = [*[pa.array(np.ascontiguousarray(words[:, i]).view(np.int64)) for i in range(length)], pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(cells, names=[*names, "hash", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tiles = shared.value, Tiles()
        for some in _sliced(batches, seed):
            if len(some.keys) < length:
                continue
            unique, word = np.unique(some.keys, return_inverse=True)
            own = np.arange(len(unique)).reshape(-1, 1)  # local numbers of the words of each local phrase
            hashes, ids = unique, word
            good = known[0].may_have(unique)[word]
            for level in known[1:]:  # phrases of two words and so on, up to the left part
                at = np.flatnonzero(good[:-1] & good[1:] & some.goes_on[:-1])
                codes, number = np.unique(ids[at] * len(unique) + word[at + own.shape[1]], return_inverse=True)
                left, right = codes // len(unique), codes % len(unique)
                hashes, own = phrase_hash(hashes[left], unique[right]), np.column_stack((own[left], right))
                good = np.zeros(len(word), dtype=bool)
                good[at] = level.may_have(hashes)[number]
                ids = np.full(len(word), -1)
                ids[at] = number
            at = np.flatnonzero(good[:-1] & good[1:] & some.goes_on[:-1])
            at = at[at + length <= len(word)]
            left, right = ids[at], word[at + length - 1]
            dense = tiles.add(known[-1].ranks(hashes, unique[own])[left], known[0].ranks(unique, unique.reshape(-1, 1))[right])
            codes, n = np.unique(left[~dense] * len(unique) + right[~dense], return_counts=True)
            if len(codes):
                yield rows(unique[np.column_stack((own[codes // len(unique)], codes % len(unique)))], n)
        for left, right, n in tiles.cells():
            yield rows(np.column_stack((known[-1].head[left], known[0].head[right])), n)

    counted = in_arrow(docs, run, ", ".join(f"{c} long" for c in (*names, "hash", "n")))
    return counted.groupBy(*names, "hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- scores -------------------------------------------------------------------------------
def _with_count(rows: DataFrame, counted: DataFrame, keys: list[str], name: str, more: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with the count of the phrase that the columns ``keys`` name."""
    own = [f"w{i}" for i in range(len(keys))]
    other = counted.select(*[F.col(o).alias(f"_{o}") for o in own], F.col("n").alias(name), *[F.col(c).alias(a) for c, a in (more or {}).items()])
    match = [F.col(k) == F.col(f"_{o}") for k, o in zip(keys, own)]
    return rows.join(other, match).drop(*[f"_{o}" for o in own])


def score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))``, in decimals of 38 digits."""
    exact = [x.cast("decimal(19,0)") for x in (a, left, right)]
    return F.call_function("div", exact[0] * exact[0] * F.lit(1_000_000), exact[1] * exact[2])


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside: int = 50, first: int = 2_000) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n and score.

    Texts, A-Z in lower case, are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
    ``[^\\x20\\x09]+``.  ``n`` counts the words of a language and ``f`` the places where a phrase
    stands within a piece.  Phrases of 2 to ``longest`` words with ``a = f(phrase) >= least`` are
    candidates.  A cut after k words gives ``l`` and ``r``, the counts of both parts, and
    ``floor(1000000 * a * a / (l * r))``; the lowest cut counts, the smallest k of equals.  One that
    stands in a longer candidate with ``100 * f >= inside * a`` is left out.  Order: score, a (both
    descending), then the phrase's bytes.

    A null text is empty, a null lang is ``und``.  Rows need no id and count one by one.  A word
    is its 64-bit key; should two words of different rows have one key, other keys are taken.
    """
    named = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(_UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    seed = 0
    while True:
        vocabulary = materialise(word_counts(named, seed, least))
        if vocabulary.where("clash").isEmpty():
            break
        seed += 1
    single = vocabulary.where("word is not null").select(F.col("key").alias("w0"), F.col("key").alias("hash"), "n", "lang", "word")
    counted, levels = [single], []
    for length in range(2, longest + 1):
        levels.append(level_of(counted[-1], [f"w{i}" for i in range(length - 1)]))
        counted.append(materialise(phrase_counts(named, seed, levels, least)))

    survivors = None
    for length in range(2, longest + 1):
        own = [f"w{i}" for i in range(length)]
        rows = counted[length - 1].select(*own, F.col("n").alias("a"))
        for k in range(1, length):
            rows = _with_count(rows, counted[k - 1], own[:k], f"l{k}", {"lang": "lang"} if k == 1 else None)
            rows = _with_count(rows, counted[length - k - 1], own[k:], f"r{k}")
        cuts = [F.struct(score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, length)]
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        for more in range(length + 1, longest + 1):  # what longer candidates have inside
            longer = counted[more - 1]
            parts = F.explode(F.array(*[F.struct(*[F.col(f"w{i + j}").alias(f"w{j}") for j in range(length)]) for i in range(more - length + 1)]))
            held = longer.select(parts.alias("part"), "n").groupBy(*[F.col(f"part.w{j}").alias(f"w{j}") for j in range(length)]).agg(F.max("n").alias("n"))
            held = held.toDF(*[f"_w{j}" for j in range(length)], "held")
            rows = rows.join(held, [F.col(f"w{j}") == F.col(f"_w{j}") for j in range(length)], "left")
            rows = rows.where(F.col("held").isNull() | (100 * F.col("held") < inside * F.col("a"))).drop("held", *[f"_w{j}" for j in range(length)])
        words = F.array(*[F.col(w) for w in own]).alias("words")
        rows = rows.select("lang", words, "a", "cut.l", "cut.r", "cut.score")
        survivors = rows if survivors is None else survivors.unionByName(rows)

    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near = materialise(survivors.withColumn("place", F.rank().over(best)).where(F.col("place") <= first).drop("place"))
    spelt = near
    for i in range(longest):
        names = single.select(F.col("w0").alias("_key"), F.col("word").alias(f"_word{i}"))
        spelt = spelt.join(names, F.try_element_at("words", F.lit(i + 1)) == F.col("_key"), "left").drop("_key")
    spelt = spelt.withColumn("phrase", F.concat_ws(" ", *[F.col(f"_word{i}") for i in range(longest)]))
    totals = vocabulary.where("word is null").select(F.col("lang").alias("_lang"), F.col("n"))
    whole = spelt.join(totals, F.col("lang") == F.col("_lang"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = whole.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
