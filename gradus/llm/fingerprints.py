"""Document fingerprints: the smallest hashes of a text's shingles.

A fingerprint is a string of ``HEX`` hexadecimal digits a hash, at most ``k`` hashes, smallest
first; the order of such numbers is the order of their digits.  It is the sketch of a set: the
sketch of a union is the smallest ``k`` of both sketches, so a text may be taken in parts and a
collection document by document.  One with fewer than ``k`` hashes holds its whole set.

Up to the smaller of the last hashes of two full sketches both sets are known, and there
their overlap is an unbiased sample: resemblance and containment are shares of it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.llm.columns import packed
from gradus.llm.kernels import mixed, shingles, slices, spans, utf8, window_hashes, word_hashes
from gradus.llm.workers import in_arrow
from gradus.operators.ordering import sketched_quantiles

WIDTH = 5
K = 128
#: Bits of a hash that a fingerprint keeps, and hexadecimal digits for them.
BITS, HEX = 48, 12
#: Bytes of a text that are hashed at a time; longer ones are taken in parts of this size.
PART = 1 << 22
#: Rows of one stretch of the doc_id order, and stretches at most (beyond that they grow).
ROWS_PER_STRETCH, STRETCHES = 2_000, 4_096

_CUTS = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], dtype=np.uint8)
_AGAINST = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


# --- sketches of texts --------------------------------------------------------------------
def smallest(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of a set given as sorted distinct 64-bit hashes, or of the union of such sets in any order."""
    return np.unique(hashes[: 2 * k] if len(hashes) > 2 * k else hashes)[:k]


def _kept(sorted_hashes: np.ndarray, k: int) -> np.ndarray:
    """Leading bits of the first hashes; two that agree in those are one."""
    return smallest(sorted_hashes[: 2 * k] >> np.uint64(64 - BITS), k)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def _in_parts(data: np.ndarray, width: int, k: int, part: int) -> np.ndarray:
    """Sketch of one long text, lower case already, from parts that end between words."""
    sketch, last, n_words, lo = np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0, 0
    while lo < len(data):
        hi = min(lo + part, len(data))
        while hi < len(data):  # on to the next white space: a word is never cut
            ends = np.flatnonzero(np.isin(data[hi : hi + part], _CUTS))
            hi = hi + int(ends[0]) if len(ends) else min(hi + part, len(data))
            if len(ends):
                break
        starts, ends, _ = spans(data[lo:hi], np.array([0, hi - lo]))
        hashes = np.concatenate((last, word_hashes(data[lo:hi], starts, ends)))
        n_words, last, lo = n_words + len(starts), hashes[-(width - 1) :] if width > 1 else hashes[:0], hi
        sketch = merge(sketch, _kept(np.unique(window_hashes(hashes, width)), k), k)
    if 0 < n_words < width:
        sketch = _kept(mixed(window_hashes(last, n_words) + np.uint64(n_words)), k)
    return sketch


def sketches(column: pa.Array, width: int = WIDTH, k: int = K, part: int = PART) -> list[np.ndarray]:
    """Sketch of each text's distinct runs of ``width`` words, A-Z in lower case.

    A text of fewer words has its whole sequence as the only one; one without words none.
    """
    data, offsets = utf8(column, lower=True)
    out: list[np.ndarray] = []
    for i, j in slices(offsets, part):
        if offsets[j] - offsets[i] > part:
            out.append(_in_parts(data[offsets[i] : offsets[j]], width, k, part))
        else:
            out += [_kept(s, k) for s in shingles(column.slice(i, j - i), width)]
    return out


def written(sketch: np.ndarray) -> str:
    return "".join(f"{h:0{HEX}x}" for h in sketch.tolist())


def read(fingerprint: str) -> np.ndarray:
    return np.array([int(fingerprint[i : i + HEX], 16) for i in range(0, len(fingerprint), HEX)], dtype=np.uint64)


def _known(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int, int]:
    """Sizes of both sketches and of their overlap, as far as both sets are known."""
    ends = [int(s[-1]) for s in (a, b) if len(s) >= k]
    if ends:
        a, b = (s[: np.searchsorted(s, min(ends), side="right")] for s in (a, b))
    return len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated size of the intersection over that of the union; 1 for two empty sets."""
    n_a, n_b, both = _known(a, b, k)
    return both / (n_a + n_b - both) if n_a + n_b else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first set that the second one has; 1 for an empty first set."""
    n_a, _, both = _known(a, b, k)
    return both / n_a if n_a else 1.0


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of different shingles; exact below ``k``."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * 2.0**BITS / (float(sketch[-1]) + 1)


# --- fingerprints in tables ---------------------------------------------------------------
def hashes_of(fingerprint: Column) -> Column:
    """The hashes of a fingerprint as an array of strings, in order."""
    return F.regexp_extract_all(fingerprint, F.lit(f"(.{{{HEX}}})"), F.lit(1))


def distinct_shingles(fingerprint: Column, k: int = K) -> Column:
    """Estimated number of different shingles, as a column; null of null."""
    n = F.octet_length(fingerprint) / HEX
    last = F.conv(F.substring(fingerprint, -HEX, HEX), 16, 10).cast("double")
    return F.when(n < k, n.cast("double")).otherwise((k - 1) * F.lit(2.0**BITS) / (last + 1))


def fingerprints(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars (code points) and fingerprint.

    A null text counts as empty; a text without words has an empty fingerprint.  Ids may be
    null or repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([written(s) for s in sketches(batch.column(2), width, k)], pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("n_chars"), text.alias("text")), run, "doc_id long, n_chars long, fingerprint string")


def merged(fingerprinted: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Fingerprint of each group's union, from the column ``fingerprint``; ``by`` columns as they are.

    Every map task sends the smallest ``k`` hashes of a group at most, so one group may hold
    most of the rows.  Null fingerprints add nothing; a group without hashes has an empty one.
    """
    row = packed(fingerprinted).select(F.struct(F.lit(0).alias("all"), *[F.col("row")[c].alias(f"k{i}") for i, c in enumerate(by)]).alias("key"), F.col("row.fingerprint").alias("fingerprint"))
    single = row.select("key", F.explode_outer(hashes_of(F.col("fingerprint"))).alias("h")).distinct()
    first = single.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.col("h").asc_nulls_last()))).where(F.col("n") <= k)
    joined = first.groupBy("key").agg(F.array_join(F.sort_array(F.collect_list("h")), "").alias("fingerprint"))
    return joined.select(*[F.col("key")[f"k{i}"].alias(c) for i, c in enumerate(by)], "fingerprint")


# --- each document against its edited text and the next document ------------------------
def _stretched(docs: DataFrame) -> DataFrame:
    """``docs`` in stretches of descending doc_id, each followed by what comes next.

    Columns: stretch, follows (true for the copy of a later stretch's first document), doc_id and
    text.  Rows without doc_id have stretches below zero.  The driver holds the cut points and
    one id per stretch, ``STRETCHES`` at most.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = min(STRETCHES, max(1, math.ceil(named.count() / ROWS_PER_STRETCH)))
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))
    cuts = []
    if n > 1:
        found = sketched_quantiles(named.select(F.col("doc_id").cast("double").alias("d")), ["d"], [i / n for i in range(1, n)], 2 * STRETCHES).first()["q_0"]
        cuts = sorted({*(found or [])})
    split = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="place", outputCol="slot") if cuts else None

    def slotted(rows: DataFrame) -> DataFrame:
        found = split.transform(rows.withColumn("place", place)).drop("place") if split else rows.withColumn("slot", F.lit(0.0))
        return found.withColumn("slot", F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(n))).otherwise(F.col("slot").cast("long")))

    heads = slotted(named.where("doc_id is not null")).groupBy("slot").agg(F.max("doc_id").alias("head")).orderBy(F.col("slot").desc()).collect()
    before = [heads[i - 1]["slot"] for i in range(len(heads))]  # the last stretch is before the first one
    led = docs.sparkSession.createDataFrame([(h["head"], s) for h, s in zip(heads, before)], "head long, before long")
    placed = slotted(named).join(F.broadcast(led), F.col("doc_id") == F.col("head"), "left")
    copies = F.array(F.struct(F.col("slot").alias("stretch"), F.lit(False).alias("follows")), F.struct(F.col("before").alias("stretch"), F.lit(True).alias("follows")))
    return placed.select("doc_id", "text", F.explode(copies).alias("at")).select("at.stretch", "at.follows", "doc_id", "text").where("stretch is not null")


def against_next(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """Each document's fingerprint next to those of its edited text and of the next document.

    Documents are in a ring by descending doc_id, rows of one doc_id by text; the last one is
    followed by the first.  In the edited text, the last ``floor(n_chars / 2)`` code points are
    replaced by as many of the next text, or by all of it.  One row per row of ``docs``: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, and the resemblances near_edited and
    near_next.  A null text is empty.  A row without doc_id has no next document: near_next is
    null, and nothing replaces what is taken from its text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            texts = batch.column("text")
            _, offsets = utf8(texts)
            for lo, hi in slices(offsets, PART):
                part = batch.slice(lo, hi - lo)
                rows = list(zip(*(part.column(c).to_pylist() for c in ("stretch", "follows", "doc_id", "text")), sketches(part.column("text"), width, k)))
                yield _edits(([last] if last else []) + rows, width, k)
                last = rows[-1]
        if last:
            yield _edits([last, None], width, k)

    ordered = _stretched(docs).repartition("stretch").sortWithinPartitions("stretch", "follows", F.col("doc_id").desc(), "text")
    return in_arrow(ordered, run, _AGAINST)


def _edits(rows: list[tuple | None], width: int, k: int) -> pa.RecordBatch:
    """Results of all rows but the last, which is there for being next."""
    pairs = [(a, b if b and a[0] == b[0] and a[0] >= 0 else None) for a, b in zip(rows, rows[1:]) if not a[1]]
    halves = [len(a[3]) // 2 for a, _ in pairs]
    edited = [a[3][: len(a[3]) - n] + (b[3][:n] if b else "") for (a, b), n in zip(pairs, halves)]
    others = sketches(pa.array(edited, pa.large_string()), width, k)
    cells = [
        pa.array([a[2] for a, _ in pairs], pa.int64()),
        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array([written(a[4]) for a, _ in pairs], pa.string()),
        pa.array([written(o) for o in others], pa.string()),
        pa.array([resemblance(a[4], o, k) for (a, _), o in zip(pairs, others)], pa.float64()),
        pa.array([resemblance(a[4], b[4], k) if b else None for a, b in pairs], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(cells, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
