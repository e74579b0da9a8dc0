"""Published models: a folder of tables per version, and a table that says which is current.

A version is written once and never changed.  Readers follow the table of publications, whose
last row names the current version, so they see a model whole or not at all.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.operators.fitting import Challenger
from gradus.operators.scoring import Scorecard
from gradus.operators.text import Categoriser

KINDS = {"scorecard": Scorecard, "challenger": Challenger, "categoriser": Categoriser}
_PUBLISHED = "version string, kind string"


def publications(spark: SparkSession, root: str) -> DataFrame:
    """version, kind, published_at of every published model; empty where there is none."""
    try:
        return spark.read.parquet(f"{root}/publications")
    except AnalysisException:  # nothing there yet
        return spark.createDataFrame([], _PUBLISHED).withColumn("published_at", F.current_timestamp())


def publish(spark: SparkSession, root: str, version: str, model: Scorecard | Challenger | Categoriser) -> None:
    """Write a model under ``version``, then name it as current.  A published version is refused."""
    kind = next(k for k, c in KINDS.items() if isinstance(model, c))
    if not publications(spark, root).where((F.col("version") == version) & (F.col("kind") == kind)).isEmpty():
        raise ValueError(f"{kind} {version} is published already")
    folder = f"{root}/{kind}/{version}"
    if isinstance(model, Categoriser):
        model.save(folder)
    else:
        model.save(spark, folder)
    row = spark.createDataFrame([(version, kind)], _PUBLISHED).withColumn("published_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{root}/publications")


def current_version(spark: SparkSession, root: str, kind: str) -> str:
    last = publications(spark, root).where(F.col("kind") == kind).agg(F.max(F.struct("published_at", "version")).alias("last")).first()["last"]
    if last is None:
        raise LookupError(f"no {kind} published in {root}")
    return last["version"]


def read_model(spark: SparkSession, root: str, kind: str, version: str | None = None) -> Scorecard | Challenger | Categoriser:
    """A published model; the current one unless a version is asked for."""
    return KINDS[kind].load(spark, f"{root}/{kind}/{version or current_version(spark, root, kind)}")
