"""Expressions and small table helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One character of white space, and what `words` are separated by.
SPACE = r"[\x20\x09-\x0D]"
_TRIM = " \t\n\x0b\f\r"

#: A table of this many ids, 16 bytes each once hashed, may be sent to every executor.
BROADCAST_IDS = 1_000_000


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for a text without any."""
    inner = F.trim(text, F.lit(_TRIM))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE + "+"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, evaluated once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that an operator's own names never clash with them."""
    return df.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row"))


def small_or_plain(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``ids`` (a written table of narrow rows) marked for broadcast if counting shows it small.

    Beyond the limit the join is an ordinary shuffled one with the same result.
    """
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``ids`` (one column ``doc_id``)."""
    own = fresh(docs, "_gone_id")
    gone = small_or_plain(ids.select(F.col("doc_id").alias(own)))
    return docs.join(gone, docs["doc_id"] == F.col(own), "left_anti")
