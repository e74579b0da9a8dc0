"""Shared inputs of the driver queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.fixed import BANDS, BETAS, CURVE, FIXED_EDGES, INTERCEPT, SEED
from gradus.operators.features import TARGET, build_gold, fit_constants
from gradus.operators.quality import clean
from gradus.operators.scoring import Scorecard
from gradus.operators.woe import woe_fit
from gradus.sources.retail import applications_raw
from gradus.sources.tables import materialise, take_split


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(applications_raw(spark, sf_dir)).drop("cleaned_at")


def staged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a written table, for queries whose operators read it several times."""
    return materialise(silver(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold with the engine-independent split, lazily over staged silver."""
    return build_gold(staged_silver(spark, sf_dir), seed=SEED, split_method="md5")


def splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    g = gold(spark, sf_dir)
    return take_split(g, "train"), take_split(g, "valid"), take_split(g, "test")


def fixed_card(train: DataFrame) -> Scorecard:
    """Fixed cut points and coefficients; WoE from the training rows."""
    bins = woe_fit(train, list(FIXED_EDGES), TARGET, monotone=False, edges=FIXED_EDGES)
    return Scorecard(bins, BETAS, INTERCEPT, CURVE, bands=BANDS)


def r6(*columns: str):
    return {c: F.round(c, 6) for c in columns}
