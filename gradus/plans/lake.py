"""Lake build: raw extract -> bronze -> silver -> gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from gradus.operators.features import ImputationConstants, build_gold, fit_constants
from gradus.operators.quality import gold_counters, quality_document, quality_report, repair_counters, repaired, stamp, written_gold_expectations
from gradus.sources.published import publish_table, read_published
from gradus.sources.tables import land_raw, materialise, read_gold, read_raw_csv, read_table, write_report, write_table


@dataclass(frozen=True)
class LakeLayout:
    """Folders of the three layers and of the reports."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/applications"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/applications"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/features"

    @property
    def published(self) -> str:
        return f"{self.root}/published/features"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def land_bronze(spark: SparkSession, raw_path: str, lake: LakeLayout, fmt: str = "parquet") -> DataFrame:
    raw = read_raw_csv(spark, raw_path)
    write_table(land_raw(raw), lake.bronze, fmt)
    return read_table(spark, lake.bronze, fmt)


def land_silver(spark: SparkSession, lake: LakeLayout, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Silver and its report.

    The counters are observed in the last stage of the write itself, where a task counts
    once however often it is retried; no second pass over the de-duplicated rows is needed.
    """
    bronze = read_table(spark, lake.bronze, fmt)
    seen = Observation("silver")
    write_table(stamp(repaired(bronze).observe(seen, *repair_counters())), lake.silver, fmt)
    after = spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{c} long" for c in seen.get))
    report = materialise(quality_report(bronze, after))
    write_report(report, lake.report("data_quality"))
    write_report(quality_document(report), lake.report("data_quality_json"), "json")
    return read_table(spark, lake.silver, fmt), report


def land_gold(spark: SparkSession, lake: LakeLayout, seed: int = 42, split_method: str = "murmur3", fmt: str = "parquet") -> tuple[DataFrame, ImputationConstants]:
    silver = read_table(spark, lake.silver, fmt)
    constants = fit_constants(silver)
    write_report(constants.to_frame(spark), lake.report("imputation_constants"))
    write_table(build_gold(silver, constants, seed, split_method), lake.gold, fmt, ["split"], ["applicant_id"])
    return read_gold(spark, lake.gold, fmt), constants


def publish_gold(gold: DataFrame, root: str, buckets: int = 200, **expected) -> str:
    """A version of gold that readers see only if it meets the expectations; ``AuditFailed`` otherwise.

    It is bucketed by applicant within each split, so joins on the applicant and counts of ids take no exchange.
    """
    def audit(written: DataFrame, counts: dict) -> DataFrame:
        return written_gold_expectations(written, counts, **expected)

    return publish_table(gold, root, audit, ["applicant_id"], buckets, ["split"], gold_counters())


def published_gold(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    return read_published(spark, root, version)


def build_lake(spark: SparkSession, raw_path: str, root: str, seed: int = 42, split_method: str = "murmur3") -> LakeLayout:
    lake = LakeLayout(root)
    land_bronze(spark, raw_path, lake)
    land_silver(spark, lake)
    land_gold(spark, lake, seed, split_method)
    return lake
