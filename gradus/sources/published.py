"""Tables that are written, audited and only then published.

The rows of a version go to a folder of their own, dealt into buckets by their key and sorted by it.
What can be counted row by row is counted by the write itself; an audit that groups by the key
reads the buckets back and needs no exchange.  A version whose checks all passed gets a row in
the table of publications, written last.  Readers follow that table, so they never see a
version that failed, or half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gradus.functions.columns import quoted

_PUBLISHED = "version string, keys array<string>, buckets int, partition_by array<string>, schema string"
_AUDITED = "version string, check string, value double, passed boolean"

#: Makes ``check, value, passed`` rows of the written rows and the counters of the write.
Audit = Callable[[DataFrame, dict], DataFrame]


class AuditFailed(RuntimeError):
    """A version stays unpublished; ``version`` names it in the table of audits."""

    def __init__(self, version: str, failed: list[str]):
        super().__init__(f"version {version} is not published, failed checks: {', '.join(failed)}")
        self.version = version


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing there yet
        return spark.createDataFrame([], schema)


def audits(spark: SparkSession, root: str) -> DataFrame:
    """version, check, value, passed of every version that was audited, published or not."""
    return _log(spark, f"{root}/audits", _AUDITED)


def publications(spark: SparkSession, root: str) -> DataFrame:
    """Published versions with how they are laid out."""
    return _log(spark, f"{root}/publications", f"{_PUBLISHED}, published_at timestamp")


def _attached(spark: SparkSession, folder: str, name: str, schema: str, keys: list[str], buckets: int, partition_by: list[str]) -> DataFrame:
    """A written version as a table whose buckets this session knows."""
    of = ", ".join(map(quoted, keys))
    parts = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))}) " if partition_by else ""
    where = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet {parts}CLUSTERED BY ({of}) SORTED BY ({of}) INTO {buckets} BUCKETS LOCATION '{where}'"
    )
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)


def publish_table(
    df: DataFrame, root: str, audit: Audit, keys: list[str], buckets: int, partition_by: list[str] | None = None, counters: list[Column] | None = None
) -> str:
    """Write ``df`` as a new version, audit it, publish it; returns the version.

    ``buckets`` is to grow with the table, a few hundred megabytes each.  Columns of
    ``partition_by`` become text.  A failed audit raises ``AuditFailed`` and leaves the rows where
    they were written, for inspection.
    """
    spark, version, partition_by = df.sparkSession, uuid.uuid4().hex, list(partition_by or [])
    df = df.withColumns({c: F.col(c).cast("string") for c in partition_by})
    last = [c for c in df.columns if c not in partition_by]
    seen, counts = Observation(version), {}
    rows = df.select(*last, *partition_by).repartition(buckets, *keys)
    if counters:
        rows = rows.observe(seen, *counters)
    folder, name = f"{root}/version={version}", f"unpublished_{version}"
    writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", folder)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    try:
        counts = seen.get if counters else counts
        checks = audit(spark.table(name), counts).select(F.lit(version).alias("version"), "check", F.col("value").cast("double").alias("value"), "passed").collect()
    finally:
        spark.sql(f"DROP TABLE {name}")  # the rows stay, the name goes
    spark.createDataFrame(checks, _AUDITED).coalesce(1).write.mode("append").parquet(f"{root}/audits")
    failed = [r["check"] for r in checks if not r["passed"]]
    if failed:
        raise AuditFailed(version, failed)
    row = spark.createDataFrame([(version, list(keys), buckets, partition_by, _ddl(rows))], _PUBLISHED)
    row.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/publications")
    return version


def read_published(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """A published version, the last one unless another is asked for.

    Tables with the same keys and number of buckets are joined, and grouped by their key, without an exchange.
    """
    known = publications(spark, root)
    if version is not None:
        known = known.where(F.col("version") == version)
    last = known.agg(F.max_by(F.struct("version", "keys", "buckets", "partition_by", "schema"), F.struct("published_at", "version")).alias("last")).first()["last"]
    if last is None:
        raise LookupError(f"nothing is published in {root}" if version is None else f"{version} is not published in {root}")
    return _attached(spark, f"{root}/version={last['version']}", f"published_{last['version']}", last["schema"], last["keys"], last["buckets"], last["partition_by"])
