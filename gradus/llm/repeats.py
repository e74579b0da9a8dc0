"""Removal of passages that occur elsewhere, by a compacted De Bruijn graph of words.

Edges of the graph are windows of ``WIDTH`` words, nodes the ``WIDTH - 1`` words between two
of them.  Windows that follow each other in a text and have the same smallest inner
``SEED`` words form a path, and paths, not windows, go through Spark: about one row per 15
words.  Equal windows have equal seeds, so

* a path whose seed occurs once has no repeated window;
* a path that occurs twice has only repeated windows, and is kept as a path;
* distinct paths of one seed may share single windows; one source of each is opened, and
  its windows are counted.

Repeated paths that follow each other in all their occurrences are compacted into one: a
join of paths on their successors finds links without a branch, and as linked paths have the
same sources, a chain is a run of neighbours in one source.  Each document gets its
repeated spans as coordinates, and checks them against its own words before it cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.llm.columns import small_or_plain
from gradus.llm.kernels import mixed, slices, spans, utf8, window_hashes, word_hashes
from gradus.llm.workers import in_arrow
from gradus.sources.tables import materialise

WIDTH = 35
SEED = 8
#: Windows of a path at most; longer ones, of words in a loop, are cut.
LONGEST = 4_096
_PIECE_BYTES = 1 << 20
#: Spans that may be sent to every executor.
BROADCAST_SPANS = 500_000


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class _Paths:
    """Paths of a few texts: the text, first window (in the text), number of windows, seed, name, successor, and whether one may hold a window twice."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray, width: int, seed: int):
        texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.windows = window_hashes(hashes, width)
        n, inner = len(self.windows), width - seed + 1
        whole = np.flatnonzero(texts[:n] == texts[width - 1 :]) if n else np.zeros(0, np.int64)
        if not len(whole):
            self.text = self.lo = self.n = np.zeros(0, np.int64)
            self.seed = self.name = self.following = np.zeros(0, np.uint64)
            self.inner = np.zeros(0, bool)
            return
        grams = window_hashes(hashes, seed)
        least = _least(grams, inner)
        new = np.ones(len(whole), bool)
        new[1:] = (np.diff(whole) != 1) | (least[whole[1:]] != least[whole[:-1]])
        at = np.flatnonzero(new)
        place = np.arange(len(whole)) - np.repeat(at, np.diff(np.append(at, len(whole))))
        at = np.flatnonzero(place % LONGEST == 0)
        start = whole[at]
        self.n = np.diff(np.append(at, len(whole)))
        self.seed = least[start]
        self.text = texts[start]
        self.lo = start - first[self.text]
        # The same windows in any order are the same for our purpose: each of them is there.
        self.name = mixed(np.add.reduceat(self.windows[whole], at) + self.n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        follows = np.append((start[1:] == start[:-1] + self.n[:-1]) & (self.text[1:] == self.text[:-1]), False)
        self.following = np.where(follows, np.append(self.name[1:], np.uint64(0)), np.uint64(0))
        # A window can come twice in a path only if its seed does.
        length = self.n + inner - 1
        begin = np.cumsum(length) - length
        places = np.arange(int(length.sum())) + np.repeat(start - begin, length)
        self.inner = np.add.reduceat((grams[places] == np.repeat(self.seed, length)).astype(np.int32), begin) > 1


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of a range of texts: first, last, word hashes, and where each text starts."""
    data, offsets = utf8(column)
    for i, j in slices(offsets, _PIECE_BYTES):
        part = data[offsets[i] : offsets[j]]
        starts, ends, first = spans(part, offsets[i : j + 1] - offsets[i])
        yield i, j, word_hashes(part, starts, ends), first


def _key() -> Column:
    """Names a row in both passes over the texts: by id and text, as ids may be null or repeated."""
    return F.xxhash64("doc_id", "text")


def _paths(read: DataFrame, width: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("k").to_numpy()
            for i, _, hashes, first in _texts(batch.column("text")):
                p = _Paths(hashes, first, width, seed)
                at = (p.lo.astype(np.int64) << 24) | (p.n.astype(np.int64) << 1) | p.inner
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[i + p.text]), *[pa.array(x.view(np.int64)) for x in (p.seed, p.name, p.following)], pa.array(at)], names=["k", "seed", "path", "following", "at"]
                )

    return in_arrow(read.select("k", "text"), run, "k long, seed long, path long, following long, at long")


_LO = "shiftright(at, 24)"
_N = "(shiftright(at, 1) & 8388607)"


def _opened(read: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """Windows of one source of each chosen path: seed, w, k, p, often."""
    places = chosen.groupBy("k").agg(F.collect_list(F.struct("at", "seed", "often")).alias("paths"))
    keys = small_or_plain(materialise(chosen.select("k").distinct()))
    texts = read.join(keys, "k", "left_semi").join(places, "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, paths = batch.column("k").to_pylist(), batch.column("paths")
            for i, j, hashes, first in _texts(batch.column("text")):
                windows = window_hashes(hashes, width)
                for t in range(i, j):
                    own = paths[t].as_py()
                    at = np.array([p["at"] for p in own], np.int64)
                    lo, n = at >> 24, (at >> 1) & 8388607
                    place = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.array([p["seed"] for p in own], np.int64), n)), pa.array(windows[place + first[t - i]].view(np.int64)),
                            pa.array(np.full(len(place), keys[t])), pa.array(place), pa.array(np.repeat(np.array([p["often"] for p in own], np.int64), n)),
                        ],
                        names=["seed", "w", "k", "p", "often"],
                    )

    return in_arrow(texts.select("k", "text", "paths"), run, "seed long, w long, k long, p long, often long")


def _compacted(paths: DataFrame) -> DataFrame:
    """path, chain and offset: repeated paths that always follow each other are one chain."""
    linked = paths.where("next_lo = next_hi AND next_lo != 0").select("path", "often", F.col("next_lo").alias("next"))
    after = paths.select(F.col("path").alias("next"), "often")
    links = linked.join(after, ["next", "often"]).select("path", "next")
    placed = paths.select("path", "k", F.expr(_LO).alias("lo"), F.expr(_N).alias("n")).join(links, "path", "left")
    source = Window.partitionBy("k").orderBy("lo", "path")
    # 0, not null: a first row and a path without link end a chain
    joins = (F.lag("next").over(source) == F.col("path")) & (F.lag(F.col("lo") + F.col("n")).over(source) == F.col("lo"))
    runs = placed.withColumn("starts", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("starts").over(source.rowsBetween(Window.unboundedPreceding, 0)))
    begin = F.min("lo").over(Window.partitionBy("k", "run"))
    return runs.select("path", F.xxhash64("k", "run").alias("chain"), (F.col("lo") - begin).alias("offset"))


def repeated(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """k, spans, singles: what is repeated in each document that has any of it.

    ``spans`` are ranges of windows with the least and greatest name of the paths in them, ``singles``
    windows with their hash.  A span is all windows from ``a`` to before ``b``.
    """
    read = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(_key().alias("k"), "text")
    paths = materialise(_paths(read, width, seed))
    inner = F.max(F.col("at").bitwiseAND(F.lit(1)))
    seeds = paths.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("lo"), F.max("path").alias("hi"), inner.alias("inner"))
    seeds = seeds.where("n > 1 OR inner = 1").select("seed", F.expr("lo != hi OR inner = 1").alias("several"))
    found = materialise(paths.join(seeds, "seed"))
    distinct = materialise(found.groupBy("seed", "path").agg(
        F.count(F.lit(1)).alias("often"), F.min("following").alias("next_lo"), F.max("following").alias("next_hi"), F.min("k").alias("k"),
        F.min_by("at", "k").alias("at"), F.max("several").alias("several"),
    ))
    windows = materialise(_opened(read, distinct.where("several"), width))
    twice = windows.groupBy("seed", "w").agg(F.sum("often").alias("n")).where("n > 1").select("seed", "w")
    singles = windows.where("often = 1").join(twice, ["seed", "w"]).select("k", F.struct("p", "w").alias("single"))
    chains = _compacted(distinct.where("often > 1"))
    whole = (
        found.select("path", "k", F.expr(_LO).alias("lo"), F.expr(_N).alias("n")).join(chains, "path")
        .groupBy("k", "chain", (F.col("lo") - F.col("offset")).alias("start"))
        .agg(F.min("lo").alias("a"), F.max(F.col("lo") + F.col("n")).alias("b"), F.min("path").alias("x"), F.max("path").alias("y"))
        .select("k", F.struct("a", "b", "x", "y").alias("span"))
    )
    both = whole.select("k", "span", F.lit(None).cast("struct<p: bigint, w: bigint>").alias("single")).unionByName(
        singles.select("k", F.lit(None).cast("struct<a: bigint, b: bigint, x: bigint, y: bigint>").alias("span"), "single")
    )
    return both.groupBy("k").agg(F.collect_list("span").alias("spans"), F.collect_list("single").alias("singles"))


def remove_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed and the kept text, for every row of ``docs``.

    A word goes if it lies in a window of ``width`` words whose sequence also starts anywhere
    else, in the same text or another one; what is left is not judged again.  Words are
    unchanged and joined by one space.  A null, empty or blank text has no words and keeps
    an empty text; a text of fewer than ``width`` words stays whole.  Rows that repeat a doc_id
    and its text repeat each other and lose what is long enough.
    """
    found = materialise(repeated(docs, width, seed))
    size = found.agg(F.coalesce(F.sum(F.size("spans") + F.size("singles")), F.lit(0)).alias("n")).first()["n"]
    right = F.broadcast(found) if size <= BROADCAST_SPANS else found
    read = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("k", _key())
    met = read.join(right, "k", "left").select("doc_id", "text", "spans", "singles")

    def cut(column: pa.Array, spans_of: pa.Array, singles_of: pa.Array) -> Iterator[np.ndarray]:
        """For each text, windows that are repeated."""
        for i, j, hashes, first in _texts(column):
            p = _Paths(hashes, first, width, seed)
            path_at = np.searchsorted(p.text, np.arange(j - i + 1))
            for t in range(i, j):
                own, one = spans_of[t].as_py() or [], singles_of[t].as_py() or []
                a, b = path_at[t - i], path_at[t - i + 1]
                lo, name = p.lo[a:b], p.name[a:b].view(np.int64)
                ends = lo + p.n[a:b]
                out = [np.zeros(0, np.int64)]
                for s in own:
                    x, y = np.searchsorted(lo, s["a"]), np.searchsorted(ends, s["b"]) + 1
                    if x < y <= len(lo) and lo[x] == s["a"] and ends[y - 1] == s["b"] and name[x:y].min() == s["x"] and name[x:y].max() == s["y"]:
                        out.append(np.arange(s["a"], s["b"]))
                if one:
                    at = np.array([s["p"] for s in one])
                    at_all = at + first[t - i]
                    fits = at + width <= first[t - i + 1] - first[t - i]
                    at, at_all, want = at[fits], at_all[fits], np.array([s["w"] for s in one])[fits]
                    out.append(at[p.windows[at_all].view(np.int64) == want])
                yield np.concatenate(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column("text")
                marked = np.flatnonzero(part.column("spans").is_valid().to_numpy(zero_copy_only=False))
                chosen = pa.array(marked)
                gone = dict(zip(marked.tolist(), cut(texts.take(chosen), part.column("spans").take(chosen), part.column("singles").take(chosen))))
                kept, total, removed = [], [], []
                for i, text in enumerate(texts.to_pylist()):
                    words = text.encode().split()
                    total.append(len(words))
                    at = gone.get(i)
                    if at is None or not len(at):
                        removed.append(0)
                    else:
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + width, -1)
                        left = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
                        removed.append(len(words) - len(left))
                        words = [words[x] for x in left.tolist()]
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "text"]
                )

    return in_arrow(met, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, text string")
