"""Near duplicates by MinHash: banded signatures, verified links, connected components.

Documents with the same shingle set are one node.  Each node has ``BANDS * ROWS`` minima of
universal hash functions; two nodes that agree on all rows of a band share a bucket.  With
32 bands of 4 rows, a pair of similarity 0.8 shares none with probability 5e-8.

Pairs of a bucket are not all written out.  First every node is checked against one
centre, the busiest node of most of its buckets, which settles groups of copies with one
check per member.  What is left are buckets whose members are still in different
components: their members are checked against members of other components, as far as sizes
and the places of shared shingles allow the similarity, so that every pair that shares a
bucket is checked, already connected or impossible.  A pair is checked on its signatures
first, then on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.columns import small_or_plain, without
from gradus.llm.components import components
from gradus.llm.kernels import mixed, shingles
from gradus.llm.workers import in_arrow
from gradus.sources.tables import materialise

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 32, 4
#: Standard deviations of the estimate by which signatures may fall short before the sets are spared.
SLACK = 6.0
#: Pairs of one centre that are checked in one run of rows.
RUN = 256
_SHINGLES_AT_ONCE = 1 << 15
_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the multiply-add family modulo 2^64."""
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


def minima(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Signatures, one row each, of sets that are not empty."""
    a, b = _functions(bands * rows)
    out = np.empty((len(sets), bands * rows), dtype=np.uint64)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= _SHINGLES_AT_ONCE):
            size += len(sets[j])
            j += 1
        items = np.concatenate(sets[i:j])
        at = np.cumsum([0, *[len(s) for s in sets[i : j - 1]]])
        for k in range(bands * rows):
            out[i:j, k] = np.minimum.reduceat(items * a[k] + b[k], at)
        i = j
    return out


def signed(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, set size, digest of the set, band keys and signature (two bytes a minimum)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = _functions(rows)[0]
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sets = shingles(part.column(1), width)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys, low, digests = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    signature = minima([sets[i] for i in full], bands, rows)
                    banded = (signature.reshape(len(full), bands, rows) * odd).sum(axis=2, dtype=np.uint64)
                    banded = mixed(banded + np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)
                    short = (signature >> np.uint64(48)).astype(np.uint16)
                    for place, i in enumerate(full):
                        keys[i], low[i] = banded[place], short[place].tobytes()
                        digests[i] = blake2b(sets[i].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(low, pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "bands", "signature"],
                )

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, _SIGNED)


def alike(left: bytes, right: bytes) -> int:
    return int((np.frombuffer(left, np.uint16) == np.frombuffer(right, np.uint16)).sum())


def likely(pairs: DataFrame, nodes: DataFrame, percent: int, minima_n: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity."""
    s = percent / 100
    least = int(minima_n * s - SLACK * (minima_n * s * (1 - s)) ** 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [alike(x, y) >= least for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    side = nodes.select("doc_id", "n_shingles", "signature")
    left = side.toDF("a", "n_a", "signature_a")
    right = side.toDF("b", "n_b", "signature_b")
    sized = pairs.join(left, "a").join(right, "b").where((F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent))
    return in_arrow(sized.select("a", "b", "signature_a", "signature_b"), run, "a long, b long")


def confirmed(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of a written table that hold on the full sets.

    Texts are sent to runs of at most ``RUN`` pairs or so of one ``a``, its own text first, so
    a task keeps one set at a time and a centre with any number of partners is spread out.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / RUN).cast("long").alias("runs"))
    dealt = materialise(pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("runs")).alias("run")))
    wanted = materialise(
        dealt.select(F.col("b").alias("id"), F.col("a").alias("centre"), "run", F.lit(True).alias("partner"))
        .unionByName(dealt.select(F.col("a").alias("id"), F.col("a").alias("centre"), "run", F.lit(False).alias("partner")).distinct())
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    sent = texts.join(small_or_plain(wanted), "id").repartition("centre", "run").sortWithinPartitions("centre", "run", "partner", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids, centres, runs, partners = (part.column(n).to_pylist() for n in ("id", "centre", "run", "partner"))
                a, b = [], []
                for i, (one, s) in enumerate(zip(ids, shingles(part.column("text"), width))):
                    if not partners[i]:
                        group, own = (centres[i], runs[i]), s
                        continue
                    if group != (centres[i], runs[i]):
                        raise ValueError(f"no text of {centres[i]} before its partners")
                    both = len(own) + len(s) - len(np.union1d(own, s))
                    if 100 * both >= percent * (len(own) + len(s) - both):
                        a.append(centres[i])
                        b.append(one)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return in_arrow(sent, run, "a long, b long")


def _with_component(buckets: DataFrame, found: DataFrame) -> DataFrame:
    named = found.select(F.col("id").alias("c_id"), "component")
    return buckets.join(named, F.col("doc_id") == F.col("c_id"), "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))


def _centres(buckets: DataFrame) -> DataFrame:
    """One pair (a, b) per node b: the centre that most of its buckets have, the busiest of equals."""
    busy = buckets.groupBy("doc_id").agg(F.sum("n").alias("score"))
    scored = buckets.join(busy, "doc_id")
    best = scored.groupBy("key").agg(F.max(F.struct("score", (-F.col("doc_id")).alias("minus"))).alias("best"))
    met = scored.join(best, "key").select(F.col("doc_id").alias("b"), F.col("best.score").alias("score"), (-F.col("best.minus")).alias("a")).where("a != b")
    counted = met.groupBy("b", "a").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("score"))
    return counted.groupBy("b").agg(F.max(F.struct("n", "score", (-F.col("a")).alias("minus"))).alias("best")).select((-F.col("best.minus")).alias("a"), "b")


def _shingle_rows(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, h) for each shingle of the documents ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                sets = shingles(part.column("text"), width)
                owner = np.repeat(part.column("doc_id").to_numpy(), [len(s) for s in sets])
                hashes = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(hashes)], names=["doc_id", "h"])

    wanted = small_or_plain(ids.select(F.col("doc_id").alias("w_id")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(texts.join(wanted, F.col("doc_id") == F.col("w_id"), "left_semi"), run, "doc_id long, h long").distinct()


def _across(docs: DataFrame, buckets: DataFrame, found: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of different components among the nodes of buckets that hold more than one.

    Shingles are put in one order, the rarest among these nodes first.  If the first one that
    two sets share stands at places i and j, they have at most ``min(size - place)`` in common,
    and similar sets need ``percent / (100 + percent)`` of both sizes.  So pairs are met on a
    shared shingle near the front of both sets, which copies changed too much for their
    centre don't have: a group of those makes few pairs, and no pair that could hold is lost.
    """
    placed = materialise(_with_component(buckets, found))
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("key")
    ids = materialise(placed.join(split, "key").select("doc_id", "component").distinct())
    rows = materialise(_shingle_rows(docs, ids, width))
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    ordered = rows.join(counts, "h").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("o"))
    n = F.size("o")
    front = ordered.select("doc_id", n.alias("n"), F.posexplode(F.slice("o", F.lit(1), n - F.ceil(n * F.lit(percent) / 100).cast("int") + 1)).alias("place", "s"))
    front = front.where("s.df > 1").select("doc_id", "n", (F.col("n") - F.col("place")).alias("left"), F.col("s.h").alias("h"))
    front = materialise(front.join(ids, "doc_id"))
    x, y = (front.toDF(*[f"{c}_{side}" for c in front.columns]) for side in "xy")
    need = (F.col("n_x") + F.col("n_y")) * percent
    possible = (F.least("left_x", "left_y") * (100 + percent) >= need) & (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent)
    apart = (F.col("h_x") == F.col("h_y")) & (F.col("doc_id_x") < F.col("doc_id_y")) & (F.col("component_x") != F.col("component_y"))
    return x.join(y, apart & possible).select(F.col("doc_id_x").alias("a"), F.col("doc_id_y").alias("b")).distinct()


def near_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept.

    Sets hold the distinct runs of ``width`` words, A-Z in lower case; a shorter text is one
    run, a null, empty or blank text has none and is linked with nothing.  Two documents are
    linked if their similarity is ``percent`` or more.  ``component_id`` is the smallest
    doc_id reachable.  Rows that share a doc_id are one node and stay or go together; a row
    without doc_id is linked with nothing, has no component and stays.
    """
    sets = materialise(signed(docs, width))
    usable = sets.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("node"))
    members = materialise(usable.select("doc_id", "digest").join(classes, "digest").select("doc_id", "node"))
    copies = materialise(members.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("node")).alias("is_node")).where(~F.col("is_node")).select("doc_id"))
    nodes = without(usable, copies)
    keyed = nodes.select("doc_id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = materialise(keyed.join(shared, "key"))
    same_id = members.where("doc_id != node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))

    first = materialise(likely(_centres(buckets), nodes, percent, BANDS * ROWS))
    links = materialise(confirmed(docs, first, width, percent))
    found = materialise(components(links))
    rest = materialise(likely(_across(docs, buckets, found, width, percent), nodes, percent, BANDS * ROWS))
    more = confirmed(docs, rest, width, percent)
    ties = found.select(F.col("component").alias("a"), F.col("id").alias("b"))
    final = components(ties.unionByName(more).unionByName(same_id))

    named = final.select(F.col("id").alias("c_id"), "component")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return sets.select("doc_id", "n_shingles").join(named, F.col("doc_id") == F.col("c_id"), "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")
    )


def deduplicate(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs``, all columns, with one document of each group of near duplicates."""
    lost = materialise(near_groups(docs, width, percent).where(~F.col("kept")).select("doc_id"))
    return without(docs, lost)
