"""A text classifier: n-gram indicators scaled by naive Bayes, and a linear hinge-loss model.

Features are hashed n-grams: single words and pairs, three bytes in a row, and whether words
repeat the one before them, four in a row.  Each is there or not.  The log ratios of how often
good and bad texts have a feature are counted over all training texts; the model
is fitted by dual coordinate descent on at most ``SAMPLE`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.llm.columns import small_or_plain
from gradus.llm.kernels import mixed, slices, spans, utf8, word_hashes
from gradus.llm.workers import in_arrow, ship
from gradus.sources.tables import materialise

BITS = 17
#: Texts that the model is fitted on, half of either class at most.
SAMPLE = 8_000
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 20
_PIECE_BYTES = 1 << 20


def features(column: pa.Array, bits: int = BITS) -> Iterator[np.ndarray]:
    """Distinct features of each text."""
    data, offsets = utf8(column)
    seen, shift = np.zeros(1 << bits, np.int64), np.uint64(64 - bits)
    for i, j in slices(offsets, _PIECE_BYTES):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = spans(part, own)
        words = word_hashes(part, starts, ends)
        pairs = mixed(words[:-1] * np.uint64(3) + words[1:])
        again = np.concatenate((np.zeros(1, np.uint64), (words[1:] == words[:-1]).astype(np.uint64))) if len(words) else words
        wide = part.astype(np.uint64)
        three = (wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)) if len(wide) > 2 else wide[:0]
        three = mixed(three + np.uint64(1 << 40))
        for a, b, lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), own[:-1].tolist(), own[1:].tolist()):
            runs = np.zeros(0, np.uint64)
            if b - a > 4:
                r = again[a + 1 : b]
                runs = mixed((r[:-3] | r[1:-2] << np.uint64(1) | r[2:-1] << np.uint64(2) | r[3:] << np.uint64(3)) + np.uint64(1 << 41))
            found = (np.concatenate((words[a:b], pairs[a : max(b - 1, a)], three[lo : max(hi - 2, lo)], runs)) >> shift).astype(np.int64)
            # Each feature keeps the place written last, so just one place finds itself again.
            seen[found] = np.arange(len(found))
            yield found[seen[found] == np.arange(len(found))]


def log_ratios(texts: DataFrame, bits: int = BITS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log of how much more often good texts have each feature; ``texts`` has text and good (0 or 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for good, found in zip(batch.column("good").to_pylist(), features(batch.column("text"), bits)):
                counts[good][found] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], names=["feature", "bad", "good"])

    # 2^bits rows at most come to the driver.
    rows = in_arrow(texts.select("text", "good"), run, "feature long, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()
    sums = np.full((2, 1 << bits), smoothing)
    for i, name in enumerate(("bad", "good")):
        sums[i][rows.column("feature").to_numpy()] += rows.column(name).to_numpy()
    sums /= sums.sum(axis=1, keepdims=True)
    return np.log(sums[1] / sums[0])


def descend(rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over scaled indicators of unit length.

    Dual coordinate descent: the multiplier of one text at a time is set to its best value
    between 0 and ``cost``; the order is shuffled with a fixed seed.
    """
    weights, bias = np.zeros(len(ratios)), 0.0
    values = [ratios[r] / max(float(np.sqrt((ratios[r] ** 2).sum())), 1e-12) for r in rows]
    squares = [float((v**2).sum()) + 1.0 for v in values]
    multipliers = np.zeros(len(rows))
    shuffle = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in shuffle.permutation(len(rows)):
            margin = signs[i] * (float(weights[rows[i]] @ values[i]) + bias)
            new = min(max(multipliers[i] - (margin - 1.0) / squares[i], 0.0), cost)
            step = (new - multipliers[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                multipliers[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights * ratios, bias


def _sample(labelled: DataFrame, size: int) -> DataFrame:
    """doc_id of ``size`` training texts, half of either class at most, by a hash of the id."""
    halves = [
        labelled.where(F.col("good") == c).select("doc_id").distinct().orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(size // 2) for c in (0, 1)
    ]
    return halves[0].unionByName(halves[1])


def scores(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", bits: int = BITS, sample: int = SAMPLE, smoothing: float = SMOOTHING, cost: float = COST
) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row of ``docs``.

    ``held_out`` is an expression on doc_id; labels of other rows are learned from, those
    that are 0 or 1 and have an id; of several labels of one id the lower counts.  A text alone
    makes its score; a null or empty one has no features and gets that of the bias.  A null
    doc_id is never held out and never labelled.  Without labels every score is 0.5.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    read = read.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    marks = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("good"))
    marks = materialise(marks.select(F.col("doc_id").cast("long").alias("doc_id"), "good").where(~held_out))
    ratios = log_ratios(read.join(small_or_plain(marks), "doc_id").select("text", "good"), bits, smoothing)

    def fit(table: pa.Table) -> pa.Table:
        rows = list(features(table.column("text"), bits))
        signs = np.where(table.column("good").to_numpy() == 1, 1.0, -1.0)
        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        weights, bias = descend([rows[i] for i in order], signs[order], ratios, cost)
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": pa.array([bias])})

    chosen = _sample(marks, sample).join(marks, "doc_id")
    texts = read.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "good")  # ``sample`` rows at most
    ship(docs.sparkSession)
    fitted = texts.groupBy(F.lit(0).alias("all")).applyInArrow(fit, "weights binary, bias double").first()
    weights, bias = (np.frombuffer(fitted["weights"]), fitted["bias"]) if fitted else (np.zeros(1 << bits), 0.0)
    sent = docs.sparkSession.sparkContext.broadcast((weights, ratios, bias))  # 2^bits numbers each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, ratios, bias = sent.value
        for batch in batches:
            margins = np.array([weights[f].sum() / max(np.sqrt((ratios[f] ** 2).sum()), 1e-12) + bias for f in features(batch.column("text"), bits)])
            score = 1.0 / (1.0 + np.exp(-2.0 * margins)) if len(margins) else margins
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return in_arrow(read, run, "doc_id long, held_out boolean, score double, predicted int")
