"""Token counts of the documents in flat token files.

A flat file is nothing but token ids in a row, each document followed by an end-of-document
id; there is no index.  A file is read in blocks.  A block is searched for the end id as a
whole, and says where its ends are, counted from its first token.  Blocks of a file are
then put in line by a prefix scan over one row each: how many tokens and documents came
before, and where the last document before the block ended.  A document that runs over a
border gets its start from the scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradus.llm.kernels import slices, spans, utf8, word_hashes
from gradus.llm.workers import in_arrow
from gradus.sources.tables import materialise, staging_dir

#: End-of-document id of files that this module makes; their ids have 32 bits.
END = 0
BLOCK_TOKENS = 1 << 18
#: Documents in a file that this module makes, so that a file is some tens of megabytes.
FILE_DOCUMENTS = 10_000
_PIECE_BYTES = 1 << 20


@dataclass(frozen=True)
class FlatFiles:
    """A folder of flat files, and which document is where in them: doc_id, part, split and ordinal."""

    path: str
    names: DataFrame


def blocks_of_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, token_bytes: int = 4) -> DataFrame:
    """file, block and data of the files under ``path``, shards of up to 2 GB each; an empty file has one empty block."""
    width = block_tokens * token_bytes
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length", "content")
    numbers = F.sequence(F.lit(0), F.expr(f"cast(greatest(length - 1, 0) div {width} as int)"))
    cut = F.transform(numbers, lambda b: F.substring("content", b * F.lit(width) + 1, F.lit(width)))
    return files.select("file", F.posexplode(cut).alias("block", "data")).withColumn("block", F.col("block").cast("long"))


def write_documents(docs: DataFrame, file_documents: int = FILE_DOCUMENTS, scanned: bool = False) -> FlatFiles:
    """Documents as flat files in the shared folder: 32-bit word ids, an end after each document, nothing else.

    Spark's text writer puts the end after each row's bytes.  Rows are read twice, for the
    tokens and for the names, and have to come in the same order each time.  A table
    read from files does; say so by ``scanned``.  Other rows are written to a table first.
    A null, empty or blank text is an empty document; null and repeated ids are kept.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in slices(offsets, _PIECE_BYTES):
                part = data[offsets[i] : offsets[j]]
                starts, ends, first = spans(part, offsets[i : j + 1] - offsets[i])
                ids = (word_hashes(part, starts, ends) % np.uint64(0xFFFFFFFF) + np.uint64(1)).astype("<u4")
                rows = [ids[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["tokens"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            columns = [batch.column("doc_id"), np.full(len(at), part), at // file_documents, at % file_documents]
            yield pa.RecordBatch.from_arrays([columns[0], *(pa.array(c, pa.int64()) for c in columns[1:])], names=["doc_id", "part", "split", "ordinal"])

    read = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    read = read if scanned else materialise(read)
    path = f"{staging_dir(docs.sparkSession).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    flat = in_arrow(read, tokens, "tokens binary").select(F.col("tokens").cast("string").alias("value"))
    end = END.to_bytes(4, "little").decode()
    flat.write.option("lineSep", end).option("compression", "none").option("maxRecordsPerFile", file_documents).text(path)
    names = in_arrow(read.select("doc_id", F.octet_length("text").alias("size")), places, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, part long, split long, ordinal long")
    return FlatFiles(path, names)


def named(scanned: DataFrame, files: FlatFiles) -> DataFrame:
    """``scanned`` documents of ``files`` with their doc_id: joined by file and ordinal after the scan."""
    number = [F.regexp_extract("file", pattern, 1).cast("long").alias(c) for c, pattern in (("part", r"/part-(\d+)-[^/]*$"), ("split", r"-c(\d+)\.[^/]*$"))]
    return scanned.select("*", *number).join(files.names, ["part", "split", "ordinal"], "left").drop("part", "split")


def scan(blocks: DataFrame, end: int = END, token_bytes: int = 4) -> DataFrame:
    """file, ordinal, start, n_tokens and finished of every document in the files.

    ``n_tokens`` leaves the end out.  Two ends in a row are an empty document.  Tokens after a
    file's last end are an unfinished document, its last row; a file without tokens has
    no rows.  A block may hold many documents, a part of one, or nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, data in zip(*(batch.column(c) for c in ("file", "block", "data"))):
                raw = data.as_buffer()
                tokens = np.frombuffer(raw, f"<u{token_bytes}") if raw is not None and raw.size else np.zeros(0, f"<u{token_bytes}")
                at = np.flatnonzero(tokens == end)
                begins = np.concatenate(([-1], at[:-1] + 1))[: len(at)]  # of the first, only the files' order tells
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file.as_py()]), pa.array([block.as_py()], pa.int64()), pa.array([len(tokens)], pa.int64()),
                        *(pa.array([x], pa.list_(pa.int64())) for x in (begins, at)),
                    ],
                    names=["file", "block", "tokens", "begins", "ends"],
                )

    found = materialise(in_arrow(blocks, run, "file string, block long, tokens long, begins array<long>, ends array<long>"))
    # One row per block, of 2^18 tokens or so: a file's blocks fit a window.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    line = found.select("file", "block", "tokens", F.size("ends").alias("n"), F.expr("try_element_at(ends, -1)").alias("last"))
    placed = line.select("*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    after_last = F.col("offset") + F.col("last") + 1
    carried = placed.select("file", "block", "offset", "earlier", F.coalesce(F.max(after_last).over(before), F.lit(0)).alias("open"))
    rows = found.select("file", "block", F.posexplode(F.arrays_zip("begins", "ends")).alias("i", "at")).join(carried, ["file", "block"])
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("offset") + F.col("at.begins"))
    whole = rows.select("file", (F.col("earlier") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("offset") + F.col("at.ends") - start).alias("n_tokens"), F.lit(True).alias("finished"))
    files = placed.groupBy("file").agg(F.sum("n").alias("ordinal"), F.coalesce(F.max(after_last), F.lit(0)).alias("start"), F.sum("tokens").alias("tokens"))
    open_tail = files.where("tokens > start").select("file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("finished"))
    return whole.unionByName(open_tail)
