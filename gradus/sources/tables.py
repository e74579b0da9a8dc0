"""Scans, sinks and staging."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Raw header -> SQL-safe column name.
RAW_COLUMN_NAMES = {
    "SeriousDlqin2yrs": "target_default_90dpd_2yr",
    "RevolvingUtilizationOfUnsecuredLines": "revolving_utilisation",
    "age": "age",
    "NumberOfTime30-59DaysPastDueNotWorse": "times_30_59_dpd",
    "DebtRatio": "debt_ratio",
    "MonthlyIncome": "monthly_income",
    "NumberOfOpenCreditLinesAndLoans": "open_credit_lines",
    "NumberOfTimes90DaysLate": "times_90_dpd",
    "NumberRealEstateLoansOrLines": "real_estate_lines",
    "NumberOfTime60-89DaysPastDueNotWorse": "times_60_89_dpd",
    "NumberOfDependents": "dependents",
}


# --- staging ------------------------------------------------------------------------------
_own_staging_dir: str | None = None
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Where that is unset, a cluster's tables go beside its warehouse, which is shared as well, and
    a local session's to a folder of its own that goes with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    global _own_staging_dir
    if _own_staging_dir is None:
        _own_staging_dir = tempfile.mkdtemp(prefix="gradus-staging-")
        atexit.register(shutil.rmtree, _own_staging_dir, ignore_errors=True)
    return _own_staging_dir


def materialise(df: DataFrame, read_as: StructType | None = None) -> DataFrame:
    """Write a DataFrame that several jobs will read to the shared folder and read it back.

    Survives lost executors (unlike a cache or a local checkpoint), is computed once, and
    keeps column pruning for the readers.  ``read_as`` names types that are stored alike.  The
    written table stands in for the shuffles behind it, so their files go once it is there.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(read_as or df.schema).parquet(path)


# --- scans and sinks ----------------------------------------------------------------------
def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column read as text; nothing is inferred."""
    return spark.read.csv(path, header=True, inferSchema=False)


def land_raw(raw: DataFrame, source_file: str | Column | None = None, renames: dict[str, str] | None = None) -> DataFrame:
    """Bronze: the unnamed first column becomes ``applicant_id``, headers become SQL-safe
    names, provenance is added and no value is altered."""
    renames = RAW_COLUMN_NAMES if renames is None else renames
    if source_file is None:
        source_file = F.col("_metadata.file_name")
    elif isinstance(source_file, str):
        source_file = F.lit(source_file)
    named = raw.withColumns({"ingested_at": F.current_timestamp(), "source_file": source_file})
    return named.withColumnsRenamed({raw.columns[0]: "applicant_id", **{k: v for k, v in renames.items() if k in raw.columns}})


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(source)


def write_table(
    df: DataFrame,
    dest: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
) -> None:
    """Overwrite a table.  Rows can be sorted inside each file for row-group skipping."""
    if sort_within:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_within)
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(dest)


def save_named_table(
    df: DataFrame, table: str, fmt: str = "parquet", partition_by: list[str] | None = None, keys: list[str] | None = None, buckets: int = 200, path: str | None = None
) -> None:
    """Overwrite a named table.

    With ``keys`` its rows are dealt by them into ``buckets`` and sorted in each; tables of the same keys and
    buckets are joined, and grouped by the keys, without an exchange.
    """
    if keys:
        df = df.repartition(buckets, *keys)
    writer = df.write.mode("overwrite").format(fmt)
    if keys:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Gold table partitioned by ``split``; a table without that column is refused."""
    df = read_table(spark, path, fmt)
    if "split" not in df.columns:
        raise ValueError("gold table has no 'split' column")
    return df.withColumn("split", F.col("split").cast("string"))


def take_split(gold: DataFrame, name: str) -> DataFrame:
    """One split; on the partitioned table this prunes to its folder."""
    return gold.filter(F.col("split") == F.lit(name))


# Appended tables.  Rows of a batch are written into a folder of their own attempt; one row in
# the table of commits, written last, makes an attempt count.  The first commit of a batch wins,
# so a job that is run again, or twice at a time, adds its rows once.
_COMMITS = "_commits"  # underscored folders are not read as part of a table
_PLACE = ["batch", "attempt"]


def commits(spark: SparkSession, dest: str) -> DataFrame:
    """batch and the attempt that counts for it."""
    try:
        log = spark.read.parquet(f"{dest}/{_COMMITS}")
    except AnalysisException:  # nothing was ever committed
        return spark.createDataFrame([], "batch string, attempt string")
    return log.groupBy("batch").agg(F.min(F.struct("committed_at", "attempt")).alias("first")).select("batch", "first.attempt")


def read_appended(spark: SparkSession, dest: str, fmt: str = "parquet") -> DataFrame:
    """Rows of all committed batches, with their ``batch``; what was never committed is not seen."""
    rows = spark.read.format(fmt).load(dest).withColumns({c: F.col(c).cast("string") for c in _PLACE})
    return rows.join(F.broadcast(commits(spark, dest)), _PLACE, "left_semi").drop("attempt")


def _append(df: DataFrame, dest: str, fmt: str, batch: str | None, audit: Callable[[DataFrame], None] | None = None) -> bool:
    """Append a batch to a table whose schema is fixed by its first rows; False if it is there already.

    Without a name every call is a batch of its own.  Other columns or types are refused.  ``audit`` is given the
    rows as they were written and raises to keep them from being committed.
    """
    spark = df.sparkSession
    batch = uuid.uuid4().hex if batch is None else batch
    try:
        stored = read_table(spark, dest, fmt).drop(*_PLACE).schema
    except AnalysisException:  # no table there yet
        stored = None
    if stored is not None:
        have, want = ({f.name: f.dataType.simpleString() for f in schema.fields} for schema in (df.schema, stored))
        if have != want:
            raise ValueError(f"{dest} holds {want}, not {have}")
    if not commits(spark, dest).where(F.col("batch") == batch).isEmpty():
        return False
    attempt = f"a{uuid.uuid4().hex}"
    written = f"{dest}/batch={quote(batch, safe='')}/attempt={attempt}"
    df.write.format(fmt).save(written)
    if audit is not None:
        audit(read_table(spark, written, fmt))
    row = spark.createDataFrame([(batch, attempt)], "batch string, attempt string").withColumn("committed_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{dest}/{_COMMITS}")
    return True


def append_decisions(
    decisions: DataFrame, dest: str, model_version: str, fmt: str = "parquet", batch: str | None = None, audit: Callable[[DataFrame], None] | None = None
) -> bool:
    """Append scored rows, stamped; the stored schema is fixed, a named batch is added once, and none that ``audit`` refuses."""
    return _append(decisions.withColumns({"scored_at": F.current_timestamp(), "model_version": F.lit(model_version)}), dest, fmt, batch, audit)


def append_monitoring_row(report: DataFrame, dest: str, model_version: str, fmt: str = "parquet", batch: str | None = None) -> bool:
    """Append the one-row monitoring record built by ``operators.drift.monitoring_record``."""
    return _append(report.withColumns({"checked_at": F.current_timestamp(), "model_version": F.lit(model_version)}), dest, fmt, batch)


def write_report(df: DataFrame, dest: str, fmt: str = "csv") -> None:
    """Report sink for result tables of a few rows: one CSV or JSON file."""
    writer = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer.csv(dest, header=True)
    else:
        writer.format(fmt).save(dest)


def landed_check(df: DataFrame, required: list[str], expected_rows: int) -> DataFrame:
    """Sanity of a landed extract: its header and its row count, as check rows."""
    spark_true = F.lit(all(c in df.columns for c in required))
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        F.expr(
            "stack(2, 'header_present', cast(null as bigint), cast(null as bigint),"
            f" 'row_count', n, cast({int(expected_rows)} as bigint)) as (check, value, expected)"
        )
    ).withColumn("passed", F.when(F.col("check") == "header_present", spark_true).otherwise(F.col("value") == F.col("expected")))


def ledger_sample(ledger: DataFrame, n: int = 500) -> DataFrame:
    """First ``n`` ledger rows in (applicant, day, transaction) order, a report sample."""
    return ledger.orderBy("applicant_id", "day", "transaction_id").limit(n)

