"""Log-probabilities of texts by a Katz backoff model of word pairs.

Counts of words, and of all pairs of words that follow each other, are discounted by Good-Turing
estimates.  What a history gives up goes to all words that it has no pair with, in proportion
to their word probability, by a backoff weight that makes each history's distribution sum to
one exactly; likewise the words give up mass to the one unknown word.  The model ends at
pairs: backing off is one step from the pair to the word, and one from the word to the unknown.

Texts are tokenised once, into chunks of about ``CHUNK_TOKENS`` tokens: the distinct words of
a chunk and the tokens as places among them.  Words lie in buckets by ranges of their hash.
A chunk sends each of its words once to the word's bucket, with its training count, and gets
the count over all chunks and the word's number back; then each of its pairs once, by the
numbers of its words, and gets their counts and their history's sums back.  So what was sent to be counted is also what is asked for, nothing
is sent twice, and what travels grows with the chunks' distinct keys, however many buckets
there are.  All that a text's probability needs is then in its chunk.

A pair goes to the bucket of its history.  Histories with more tokens than a part of a bucket's
share are hot: their pairs are dealt by the pair's own hash, and their sums are added up over
buckets and sent to every task (``SENT_SHARE`` bounds how many there are).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.llm.kernels import mixed, slices, spans, utf8, word_hashes
from gradus.llm.workers import in_arrow, ship
from gradus.sources.tables import materialise

#: Least share of the tokens for a history to be hot, so that 1 / SENT_SHARE are at most.
SENT_SHARE = 1e-6
#: A history is hot from this part of a bucket's tokens.
HOT_PART = 8
#: Counts up to this one are discounted.
DISCOUNTED = 5
#: Bytes of text per bucket; the pairs of a bucket are counted in one task.
BUCKET_BYTES = 16_000_000
#: Tokens of a chunk (more where a single text has more).
CHUNK_TOKENS = 1_000_000
_PIECE_BYTES = 1 << 20
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
WORDS, PAIRS, HOT = 0, 1, 2


# --- numbers in a few bytes ---------------------------------------------------------------
def packed(values: np.ndarray) -> bytes:
    """Numbers of 64 bits (doubles by their bits) as compressed planes of bytes, the highest that are used first."""
    values = np.ascontiguousarray(values)
    bits = values.view("<u8") if values.dtype.itemsize == 8 else values.astype("<u8")
    width = (int(bits.max()).bit_length() + 7) // 8 if len(bits) else 0
    planes = np.ascontiguousarray(bits.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return len(bits).to_bytes(8, "little") + bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if width else b"")


def unpacked(raw: bytes, kind: str = "<i8") -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), raw[8]
    out = np.zeros((n, 8), np.uint8)
    if width:
        planes = pa.decompress(raw[9:], decompressed_size=n * width, codec="zstd")
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.reshape(-1).view(kind)


def packed_steps(ascending: np.ndarray) -> bytes:
    return packed(np.diff(ascending, prepend=ascending.dtype.type(0)))


def unpacked_steps(raw: bytes, kind: str = "<i8") -> np.ndarray:
    return np.cumsum(unpacked(raw, kind), dtype=kind)


# --- chunks -------------------------------------------------------------------------------
def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of hashes, so that ascending keys are in ascending buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pair_keys(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(history * _PAIR + word)


def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of a range of texts: first, last, tokens (an end after each text) and how many each text has."""
    data, offsets = utf8(column, lower=True)
    for i, j in slices(offsets, _PIECE_BYTES):
        own, part = offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]
        starts, ends, first = spans(part, own)
        yield i, j, np.insert(word_hashes(part, starts, ends), first[1:], END), np.diff(first) + 1


_CHUNKS = "chunk long, start long, ids binary, nulls binary, held binary, lengths binary, words binary, often binary, tokens binary"


def _chunk_row(number: int, parts: list) -> pa.RecordBatch:
    """A chunk's texts, its distinct words (START among them) with their training counts, and its tokens' places."""
    ids, nulls, held, tokens, lengths = (np.concatenate(x) for x in zip(*parts))
    words, at = np.unique(np.append(tokens, START), return_inverse=True)
    often = np.bincount(at[:-1][np.repeat(~held, lengths)], minlength=len(words))
    often[at[-1]] += int((~held).sum())
    row = [packed(ids), packed(nulls), packed(held), packed(lengths), packed_steps(words), packed(often), packed(at[:-1])]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([at[-1]], pa.int64()), *(pa.array([x], pa.binary()) for x in row)], names=[c.split()[0] for c in _CHUNKS.split(", ")])


@dataclass(frozen=True)
class _Pairs:
    """Distinct pairs of a chunk, ascending by places of history and word, and which of them each token is."""

    history: np.ndarray
    word: np.ndarray
    of_token: np.ndarray

    @staticmethod
    def of(tokens: np.ndarray, lengths: np.ndarray, start: int) -> _Pairs:
        before = np.concatenate((tokens[:1], tokens[:-1]))
        before[np.cumsum(lengths) - lengths] = start
        width = max(int(tokens.max()), start) + 1
        keys, of_token = np.unique(before * width + tokens, return_inverse=True)
        return _Pairs(keys // width, keys % width, of_token)

    def dealt(self, numbers: np.ndarray, counts: np.ndarray, line: float, buckets: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Kind, bucket and pairs that go there; the same for the same chunk, numbers and counts."""
        hot = counts[self.history] >= line
        for kind, some in ((PAIRS, np.flatnonzero(~hot)), (HOT, np.flatnonzero(hot))):
            h, w = numbers[self.history[some]], numbers[self.word[some]]
            where = h % buckets if kind == PAIRS else bucket_of(pair_keys(h.view("<u8"), w.view("<u8")), buckets)
            if kind == HOT:
                order = np.argsort(where, kind="stable")
                some, where = some[order], where[order]
            at = np.flatnonzero(np.diff(where, prepend=-1))
            for i, j in zip(at.tolist(), np.append(at[1:], len(where)).tolist()):
                yield kind, int(where[i]), some[i:j]


def _runs(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal items begin, and how long they are."""
    at = np.flatnonzero(np.concatenate(([True], ascending[1:] != ascending[:-1]))) if len(ascending) else np.zeros(0, np.int64)
    return at, np.diff(np.append(at, len(ascending)))


# --- counting in buckets ------------------------------------------------------------------
#: What a bucket answers a chunk with, in the order it was asked; rows without a chunk have sums for all.
_ANSWER = "chunk long, bucket int, kind int, counts binary, few binary, lower binary, stats array<long>"


def _answers(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    return pa.table({c.split()[0]: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(zip(_ANSWER.split(", "), kinds))})


def _having(counts: np.ndarray) -> list[int]:
    """How many keys have each count up to DISCOUNTED + 1 (index 0 unused)."""
    return np.bincount(counts[(counts > 0) & (counts <= DISCOUNTED + 1)], minlength=DISCOUNTED + 2).tolist()


def _count_words(asked: pa.Table) -> pa.Table:
    if not asked.num_rows:
        return _answers([])
    bucket = asked.column("bucket")[0].as_py()
    keys = [unpacked_steps(x.as_py(), "<u8") for x in asked.column("words")]
    cuts = np.cumsum([0, *map(len, keys)])
    words, at = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.zeros(len(words), np.int64)
    np.add.at(counts, at, np.concatenate([unpacked(x.as_py()) for x in asked.column("often")]))
    seen = counts[(words != START) & (counts > 0)]
    rows = []
    for i, chunk in enumerate(asked.column("chunk").to_pylist()):
        own = at[cuts[i] : cuts[i + 1]]
        rows.append((chunk, bucket, WORDS, packed(counts[own]), packed_steps(own), None, None))
    return _answers([*rows, (None, bucket, WORDS, None, None, None, [int(seen.sum()), len(seen), *_having(seen)])])


_ASKED = "bucket int, kind int, chunk long, histories binary, lengths binary, words binary, often binary, seen binary"


def _chunk_pairs(line: float, buckets: int, chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """The distinct pairs of a chunk with their training counts and their words' counts, dealt out."""
    rows = []
    for row in chunk.to_pylist():
        lengths, held = unpacked(row["lengths"]), unpacked(row["held"]) == 1
        numbers, counts = _word_answers(answers, buckets)
        pairs = _Pairs.of(unpacked(row["tokens"]), lengths, row["start"])
        often = np.bincount(pairs.of_token[np.repeat(~held, lengths)], minlength=len(pairs.word))
        for kind, bucket, some in pairs.dealt(numbers, counts, line, buckets):
            at, runs = _runs(pairs.history[some])
            h, w = numbers[pairs.history[some[at]]], pairs.word[some]
            # A bucket's own words ascend, and their place in the bucket says which they are.
            histories = packed_steps(h // buckets) if kind == PAIRS else packed(h)
            rows.append((bucket, kind, row["chunk"], histories, packed(runs), packed(numbers[w]), packed(often[some]), packed(counts[w])))
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.table({c.split()[0]: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(zip(_ASKED.split(", "), kinds))})


def _word_answers(answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of a chunk's words; its buckets are ranges of them.  Numbers of a bucket's words are alike modulo ``buckets``."""
    found = sorted((b, n, c) for b, k, n, c in zip(*(answers.column(x).to_pylist() for x in ("bucket", "kind", "few", "counts"))) if k == WORDS)
    return np.concatenate([unpacked_steps(n) * buckets + b for b, n, _ in found]), np.concatenate([unpacked(c) for *_, c in found])


def _count_pairs(model: Model, asked: pa.Table) -> pa.Table:
    """Counts of a bucket's pairs for each chunk, and per history how many pairs have each low count and, if asked for an unknown pair, the probability of their words."""
    if not asked.num_rows:
        return _answers([])
    bucket = asked.column("bucket")[0].as_py()
    kinds, chunks = asked.column("kind").to_pylist(), asked.column("chunk").to_pylist()
    out, stats = [], np.zeros(DISCOUNTED + 2, np.int64)
    for kind in (PAIRS, HOT):
        mine = [i for i, k in enumerate(kinds) if k == kind]
        if not mine:
            continue
        col = {n: [asked.column(n)[i].as_py() for i in mine] for n in ("histories", "lengths", "words", "often", "seen")}
        own = [(unpacked_steps if kind == PAIRS else unpacked)(x) for x in col["histories"]]
        h = np.concatenate([np.repeat(k, unpacked(n)) for k, n in zip(own, col["lengths"])])
        w = np.concatenate([unpacked(x) for x in col["words"]])
        cuts = np.cumsum([0, *(int.from_bytes(x[:8], "little") for x in col["words"])])
        order = np.lexsort((w, h))
        h, w = h[order], w[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])))
        at = np.flatnonzero(new)
        sums = np.add.reduceat(np.concatenate([unpacked(x) for x in col["often"]])[order], at)
        log_word = model.log_word(np.concatenate([unpacked(x) for x in col["seen"]])[order[at]])
        counts = np.empty(len(order), np.int64)
        counts[order] = sums[np.cumsum(new) - 1]
        stats += _having(sums)
        # Per history, over its distinct pairs.
        h = h[at]
        first, _ = _runs(h)
        few = np.add.reduceat(sums[None, :] == np.arange(1, DISCOUNTED + 1)[:, None], first, axis=1, dtype=np.int64)
        lower = np.add.reduceat(np.where(sums > 0, 10.0**log_word, 0.0), first)
        h = h[first]
        for i, row in enumerate(mine):
            back = np.searchsorted(h, own[i]) if kind == PAIRS else np.zeros(0, np.int64)
            mine_counts = counts[cuts[i] : cuts[i + 1]]
            # Only where a pair is unknown does its history back off.
            starts = np.cumsum(unpacked(col["lengths"][i])) - unpacked(col["lengths"][i])
            needed = np.minimum.reduceat(mine_counts, starts) == 0 if kind == PAIRS else np.zeros(0, bool)
            out.append((chunks[row], bucket, kind, packed(mine_counts), packed(few[:, back].reshape(-1)), packed(np.where(needed, lower[back], 0.0)), None))
        if kind == HOT:
            out.append((None, bucket, HOT, h.tobytes(), few.T.tobytes(), lower.tobytes(), None))
    return _answers([*out, (None, bucket, PAIRS, None, None, None, stats.tolist())])


def _stats(answers: DataFrame, width: int) -> np.ndarray:
    parts = answers.where(F.col("stats").isNotNull())
    return np.array(parts.agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"v{i}") for i in range(width)]).first())


def _hot_sums(answers: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hot histories, sorted, with their sums over all buckets; 1 / SENT_SHARE at most, so they may go to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in zip(*(batch.column(c).to_pylist() for c in ("counts", "few", "lower"))):
                h, few, lower = (np.frombuffer(x, t) for x, t in zip(raw, ("<i8", "<i8", "<f8")))
                few = few.reshape(len(h), DISCOUNTED)
                yield pa.RecordBatch.from_arrays([pa.array(h), *(pa.array(few[:, i]) for i in range(DISCOUNTED)), pa.array(lower)], names=["h", *names, "lower"])

    names = [f"n{i}" for i in range(1, DISCOUNTED + 1)]
    parts = answers.where(F.col("chunk").isNull() & (F.col("kind") == HOT)).select("counts", "few", "lower")
    parts = in_arrow(parts, run, f"h long, {', '.join(n + ' long' for n in names)}, lower double")
    rows = parts.groupBy("h").agg(*[F.sum(c).alias(c) for c in (*names, "lower")]).toArrow()
    h = rows.column("h").to_numpy()
    order = np.argsort(h)
    few = np.array([rows.column(n).to_numpy() for n in names], np.int64).reshape(DISCOUNTED, -1)
    return h[order], few[:, order], rows.column("lower").to_numpy()[order]


# --- the model ----------------------------------------------------------------------------
def discounts(having: np.ndarray) -> np.ndarray:
    """Katz's factor for each count up to DISCOUNTED, from how many keys have each count (index = count).

    Where the Good-Turing estimate is no fraction between 0 and 1, as on little data, half a
    count is taken off instead.  Index 0 is unused.
    """
    out = np.ones(DISCOUNTED + 1)
    for r in range(1, DISCOUNTED + 1):
        d = math.nan
        if having[1] > 0 and having[r] > 0:
            top = (DISCOUNTED + 1) * having[DISCOUNTED + 1] / having[1]
            if top < 1:
                d = ((r + 1) * having[r + 1] / (having[r] * r) - top) / (1 - top)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= DISCOUNTED, factors[np.minimum(counts, DISCOUNTED)], 1.0)


@dataclass(frozen=True)
class Model:
    """What every task knows of the words: how many, and how their counts become probabilities."""

    n: int
    v: int
    factors: np.ndarray
    scale: float
    log_unknown: float

    def log_word(self, counts: np.ndarray) -> np.ndarray:
        """log10 probability of words with these training counts."""
        if not self.n:
            return np.full(len(counts), self.log_unknown)
        share = discounted(counts, self.factors) * self.scale / self.n
        return np.where(counts > 0, np.log10(np.where(counts > 0, share, 1.0)), self.log_unknown)


def word_model(n: int, v: int, having: np.ndarray) -> Model:
    factors = discounts(having)
    r = np.arange(1, DISCOUNTED + 1)
    taken = (n - float((r * having[r] * (1 - factors[r])).sum())) / n if n else 0.0
    scale = min(1.0, (n / (n + 1)) / taken) if taken else 1.0
    return Model(n, v, factors, scale, math.log10(1.0 - scale * taken) if n else 0.0)


def weights(counts: np.ndarray, few: np.ndarray, lower: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the backoff weight of histories, and of what their pairs' discounted counts are multiplied by.

    ``few`` says how many of a history's pairs have each discounted count, ``lower`` is the
    probability of its pairs' words.  Each training token but an end has one pair, so the other
    pairs make up the rest of the count.  A history none of whose pairs is discounted still
    leaves one part of its count plus one; a history that was never trained on leaves all.
    """
    r = np.arange(1, DISCOUNTED + 1)
    known = np.maximum(counts, 1)
    own = (known - ((1 - factors[1:]) * r) @ few) / known
    scales = np.minimum(1.0, (known / (known + 1)) / np.maximum(own, 1e-300))
    backoff = np.log10((1.0 - scales * own) / np.maximum(1.0 - lower, 1e-300))
    return np.where(counts > 0, backoff, 0.0), np.log10(scales / known)


# --- scoring ------------------------------------------------------------------------------
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _scored(model: Model, pair_factors: np.ndarray, hot: tuple[np.ndarray, np.ndarray, np.ndarray], line: float, buckets: int, chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """The texts of one chunk."""
    out = []
    for row in chunk.to_pylist():
        tokens, lengths = unpacked(row["tokens"]), unpacked(row["lengths"])
        numbers, counts = _word_answers(answers, buckets)
        log_word = model.log_word(counts)
        pairs = _Pairs.of(tokens, lengths, row["start"])
        found = {(k, b): x for b, k, *x in zip(*(answers.column(n).to_pylist() for n in ("bucket", "kind", "counts", "few", "lower"))) if k != WORDS}
        pair_counts = np.zeros(len(pairs.word), np.int64)
        few, lower = np.zeros((DISCOUNTED, len(counts)), np.int64), np.zeros(len(counts))
        led = np.flatnonzero(counts >= line)
        if len(hot[0]) and len(led):
            at = np.minimum(np.searchsorted(hot[0], numbers[led]), len(hot[0]) - 1)
            same = hot[0][at] == numbers[led]  # a hot word that is no history, as an end, has no sums
            led, at = led[same], at[same]
            few[:, led], lower[led] = hot[1][:, at], hot[2][at]
        for kind, bucket, some in pairs.dealt(numbers, counts, line, buckets):
            own_counts, own_few, own_lower = found[kind, bucket]
            pair_counts[some] = unpacked(own_counts)
            if kind == PAIRS:
                own = pairs.history[some[_runs(pairs.history[some])[0]]]
                few[:, own], lower[own] = unpacked(own_few).reshape(DISCOUNTED, -1), unpacked(own_lower, "<f8")
        backoff, lead = weights(counts, few, lower, pair_factors)
        taken = discounted(pair_counts, pair_factors)
        score = np.where(pair_counts > 0, np.log10(np.where(pair_counts > 0, taken, 1.0)) + lead[pairs.history], backoff[pairs.history] + log_word[pairs.word])
        n = len(lengths)
        text = np.repeat(np.arange(n), lengths)
        known = np.bincount(text, counts[tokens] > 0, n)
        base = np.bincount(text, np.log10(counts + 1.0)[tokens], n)
        out.append(pa.table({
            "doc_id": pa.array(unpacked(row["ids"]), mask=unpacked(row["nulls"]) == 1), "held_out": pa.array(unpacked(row["held"]) == 1), "n_tokens": pa.array(lengths),
            "n_known": pa.array(np.rint(known).astype("<i8")), "base": pa.array(base), "score": pa.array(np.bincount(text, score[pairs.of_token], n)),
        }))
    return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), **{c: pa.array([], t) for c, t in (("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()))}})


def _chunks(read: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids = batch.column("doc_id")
            nulls, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            for i, j, tokens, lengths in _tokens(batch.column("text")):
                parts.append((ids[i:j], nulls[i:j], held[i:j], tokens, lengths))
                size += len(tokens)
                if size >= CHUNK_TOKENS:
                    yield _chunk_row(number, parts)
                    number, parts, size = number + 1, [], 0
        if parts:
            yield _chunk_row(number, parts)

    return materialise(in_arrow(read, run, _CHUNKS))


def _asked_words(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, often in zip(*(batch.column(c).to_pylist() for c in ("chunk", "words", "often"))):
                words, often = unpacked_steps(words, "<u8"), unpacked(often)
                where = bucket_of(words, buckets)
                at, runs = _runs(where)
                rows = [(int(where[i]), packed_steps(words[i : i + n]), packed(often[i : i + n])) for i, n in zip(at.tolist(), runs.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))],
                    names=["bucket", "chunk", "words", "often"],
                )

    return in_arrow(chunks.select("chunk", "words", "often"), run, "bucket int, chunk long, words binary, often binary")


def scores(docs: DataFrame, held_out, bucket_bytes: int = BUCKET_BYTES, sent_share: float = SENT_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A-Z in lower case, and one end per text; a null or empty text is its
    end.  ``held_out`` is an expression on doc_id; other texts are trained on, also those of
    a null doc_id, of which the expression is null.  ``score`` is log10 of the model's
    probability, ``base_score`` that of add-one words.  Rows that repeat a doc_id count and
    are scored each by itself.  Without training texts every word is the unknown one.  An empty
    table gives no rows.  doc_id is a whole number or its text; other texts are refused.

    All pairs are modelled.  ``bucket_bytes`` and ``sent_share`` (the least share of the tokens
    from which a history's sums may go to every task) have no part in the result.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = read.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(size / bucket_bytes))
    ship(docs.sparkSession)
    chunks = _chunks(read)
    words = materialise(_asked_words(chunks, buckets).groupBy("bucket").applyInArrow(_count_words, _ANSWER))
    n, v, *having = _stats(words, DISCOUNTED + 4).tolist()
    model = word_model(n, v, np.array(having, float))
    line = max(1.0, n / (HOT_PART * buckets), sent_share * n)
    words = words.where(F.col("chunk").isNotNull())
    asked = chunks.select("chunk", "start", "held", "lengths", "tokens").groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(lambda left, right: _chunk_pairs(line, buckets, left, right), _ASKED)
    pairs = materialise(asked.groupBy("bucket").applyInArrow(lambda part: _count_pairs(model, part), _ANSWER))
    pair_factors = discounts(_stats(pairs, DISCOUNTED + 2).astype(float))
    hot = _hot_sums(pairs)
    answers = words.unionByName(pairs.where(F.col("chunk").isNotNull()))
    texts = chunks.select("chunk", "start", "ids", "nulls", "held", "lengths", "tokens").groupBy("chunk")
    found = texts.cogroup(answers.groupBy("chunk")).applyInArrow(lambda left, right: _scored(model, pair_factors, hot, line, buckets, left, right), _SCORED)
    total = math.log10(model.n + 1 * (model.v + 1))
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * F.lit(total)).alias("base_score"), "score",
    )
