"""Byte-level BPE by a tree of halves.

A long piece is cut in half, the halves are encoded, and the results are joined.  A join
encodes the bytes around the seam anew, from one token on either side.  A token sequence
is the encoding of its bytes just when each two neighbours are the encoding of theirs: the
first merge that crosses a border depends on the two tokens beside it alone.  So the window
is final once it agrees with the tokens next to it; until then it grows.
Joining is associative, hence any tree gives the same tokens.  Decoding joins bytes.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gradus.llm.workers import in_arrow

#: Bytes that are merged directly.
LEAF = 24
#: Matches, and stretches between spaces, that a worker remembers; how many doesn't change results.
REMEMBERED, REMEMBERED_STRETCHES = 300_000, 400_000
REMEMBERED_LENGTH = 64
#: A text of more code points is split into pieces in steps, not in one list; the pieces are the same.
STEP_FROM = 1_000_000
STEP = 100_000


class Encoder:
    """Encoding by the ranks of a rank file, each match of ``pattern`` separately."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        # A space amid white space belongs to a run that has to be seen as a whole.
        self.in_run = regex.compile(r"\s (?:\s|\Z)")
        self.agreeing: dict[tuple[int, int], bool] = {}
        # Matches, and stretches from a space on by what follows it.
        self.pieces = _Known(lambda piece: _packed(self.piece(piece.encode())), REMEMBERED)
        self.stretches = _Known(lambda rest: self.matches(" " + rest), REMEMBERED_STRETCHES)

    def merge(self, raw: bytes) -> list[int]:
        """Merges of the lowest rank first, the leftmost of equals."""
        if len(raw) > 4 * LEAF:
            return self._merge_long(raw)
        rank_of, never = self.ranks.get, len(self.tokens)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [rank_of(raw[i : i + 2], never) for i in range(len(raw) - 1)]
        while pairs and (low := min(pairs)) != never:
            at = pairs.index(low)
            made = parts[at] + parts.pop(at + 1)
            parts[at] = made
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank_of(made + parts[at + 1], never)
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + made, never)
        return [rank_of(p) for p in parts]

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same by a queue of pairs; a pair that changed since it was queued is passed over."""
        ranks, n = self.ranks, len(raw)
        ends, before = list(range(1, n + 1)), list(range(-1, n))
        gone = bytearray(n + 1)

        def pair(i: int) -> int | None:
            j = ends[i]
            return ranks.get(raw[i : ends[j]]) if j < n else None

        queue = [(rank, i) for i in range(n) if (rank := pair(i)) is not None]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            if gone[i] or pair(i) != rank:
                continue
            j = ends[i]
            ends[i], gone[j] = ends[j], 1
            before[ends[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (made := pair(k)) is not None:
                    heappush(queue, (made, k))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : ends[i]]])
            i = ends[i]
        return out

    def agree(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are what their bytes encode to."""
        found = self.agreeing.get((left, right))
        if found is None:
            if len(self.agreeing) >= REMEMBERED:
                self.agreeing.clear()
            found = self.agreeing[left, right] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of two encodings together."""
        i, j = min(1, len(left)), min(1, len(right))
        while i and j:
            middle = self.merge(b"".join(self.tokens[t] for t in left[len(left) - i :] + right[:j]))
            grow_left = i < len(left) and not self.agree(left[-i - 1], middle[0])
            grow_right = j < len(right) and not self.agree(middle[-1], right[j])
            if not (grow_left or grow_right):
                return left[: len(left) - i] + middle + right[j:]
            i = min(2 * i, len(left)) if grow_left else i
            j = min(2 * j, len(right)) if grow_right else j
        return left + right

    def tree(self, raw: bytes) -> list[int]:
        if len(raw) <= LEAF:
            return self.merge(raw)
        half = len(raw) // 2
        return self.join(self.tree(raw[:half]), self.tree(raw[half:]))

    def piece(self, raw: bytes) -> list[int]:
        """A piece that is a token as a whole is that token, whatever merges would make."""
        whole = self.ranks.get(raw)
        return self.tree(raw) if whole is None else [whole]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A space starts a new match unless it lies in a run of white space, so a text without
        such spaces is cut at its spaces, and most stretches are known from before.
        """
        if self.in_run.search(text) or len(text) > STEP_FROM:
            return self.matches(text)
        first, *others = text.split(" ")
        return self.matches(first) + b"".join(map(self.stretches.__getitem__, others))

    def matches(self, text: str) -> bytes:
        """Ids of a text, match by match."""
        if len(text) <= STEP:
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
        found, parts = (m.group() for m in self.pattern.finditer(text)), []
        while step := list(islice(found, STEP)):
            parts.append(b"".join(map(self.pieces.__getitem__, step)))
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        width, parts = 4 * STEP, []
        for at in range(0, len(ids), width):
            parts.append(b"".join(map(self.tokens.__getitem__, np.frombuffer(ids[at : at + width], "<u4").tolist())))
        return b"".join(parts)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """Ids of texts seen before: a young half of ``most`` texts, and the half before it."""

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.most, self.old = encode, most, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(text) <= REMEMBERED_LENGTH:
            if 2 * len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[text] = ids
        return ids


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder_of(rank_file: bytes, pattern: str) -> Encoder:
    """The worker's encoder, kept between tasks."""
    key = (zlib.crc32(rank_file), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(rank_file, pattern)
    return _encoders[key]


def _mapped(df: DataFrame, column: str, made: dict[str, Callable[[Encoder, object], bytes]], rank_file: bytes, pattern: str) -> DataFrame:
    gone = {column, *made}
    names = [f.name for f in df.schema.fields if f.name.lower() not in {c.lower() for c in gone}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(rank_file, pattern)
        for batch in batches:
            values = batch.column(column)
            for lo in range(0, len(values), 256):
                part = values.slice(lo, 256)
                done: dict[str, list] = {k: [] for k in made}
                for value in part:
                    made_of = value.as_py()
                    for k, f in made.items():
                        made_of = f(encoder, made_of)
                        done[k].append(made_of)
                kept = [batch.column(n).slice(lo, 256) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(v, pa.binary()) for v in done.values()]], names=[*names, *made])

    fields = ", ".join([*[f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names], *[f"`{k}` binary" for k in made]])
    return in_arrow(df, run, fields)


def encode(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by ``ids``, little-endian unsigned 32-bit integers.

    A null or empty text has no ids.  Every row is encoded by itself; the order of columns is
    kept but for ``ids``, which comes last and replaces a column of that name.
    """
    return _mapped(docs, text, {"ids": lambda e, t: e.encode(t or "")}, rank_file, pattern)


def decode(encoded: DataFrame, rank_file: bytes, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``ids`` replaced by the ``decoded`` bytes, also a column of that name."""
    return _mapped(encoded, ids, {"decoded": lambda e, t: e.decode(t or b"")}, rank_file, pattern)


def round_trip(docs: DataFrame, rank_file: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: columns ``ids`` and ``decoded`` for ``text`` and for columns of these names."""
    return _mapped(docs, text, {"ids": lambda e, t: e.encode(t or ""), "decoded": lambda e, ids: e.decode(ids)}, rank_file, pattern)
