"""Scorecard parameters and native scoring expressions (no UDF, no join)."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradus.functions.columns import DEFAULT_BANDS, ScoreScaling, assign_band, total
from gradus.operators.ordering import sketched_quantiles
from gradus.operators.woe import WoeBins, woe_transform

PD_FLOOR = 1e-6


@dataclass(frozen=True)
class IsotonicCurve:
    """Step points of a fitted isotonic calibrator; linear between, flat outside."""

    boundaries: list[float]
    predictions: list[float]

    def add(self, df: DataFrame, raw: str, out: str) -> DataFrame:
        b, y = self.boundaries, self.predictions
        if len(b) == 1:
            return df.withColumn(out, F.lit(float(y[0])))
        # Bucketizer does a binary search on the JVM, so the curve may have many points.
        placed = Bucketizer(splits=[-math.inf, *b, math.inf], inputCol=raw, outputCol="_slot").transform(df)
        x_points, y_points = F.array(*[F.lit(float(v)) for v in b]), F.array(*[F.lit(float(v)) for v in y])
        slot = F.col("_slot").cast("int")
        x0, x1 = F.get(x_points, slot - 1), F.get(x_points, slot)
        y0, y1 = F.get(y_points, slot - 1), F.get(y_points, slot)
        inside = y0 + (y1 - y0) * (F.col(raw) - x0) / (x1 - x0)
        value = F.when(slot == 0, F.lit(float(y[0]))).when(slot == len(b), F.lit(float(y[-1]))).otherwise(inside)
        return placed.withColumn(out, value).drop("_slot")


@dataclass(frozen=True)
class IsotonicTable:
    """A step curve of any number of points, kept as a table (x, y) and met by an interval lookup.

    Points are grouped into stretches of x, each with the points beside it; a row meets its
    stretch in a join with a key and looks up its neighbours there.
    """

    points: DataFrame
    stretches: int = 1_024

    def add(self, df: DataFrame, raw: str, out: str) -> DataFrame:
        cuts: list[float] = []
        if self.stretches > 1:
            found = sketched_quantiles(self.points, ["x"], [i / self.stretches for i in range(1, self.stretches)], max(64, 4 * self.stretches)).first()["q_0"]
            cuts = sorted({*(found or [])})

        def split(rows: DataFrame, column: str) -> DataFrame:
            if not cuts:
                return rows.withColumn("_slot", F.lit(0.0))
            return Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=column, outputCol="_slot").transform(rows)

        grouped = split(self.points, "x").groupBy("_slot").agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("own"))
        beside = Window.orderBy("_slot")  # a row per stretch
        before, after = F.lag("own").over(beside), F.lead("own").over(beside)
        near = grouped.select(F.col("_slot").alias("_place"), F.concat(
            F.coalesce(F.slice(before, -1, 1), F.array()), "own", F.coalesce(F.slice(after, 1, 1), F.array())
        ).alias("_near"))
        # Stretches without points of their own have those of the nearest ones around them.
        every = self.points.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("double").alias("_place"))
        order = Window.orderBy("_place")
        filled = every.join(near, "_place", "left").select("_place", "_near", F.last("_near", True).over(order).alias("_l"), F.first("_near", True).over(order.rowsBetween(0, Window.unboundedFollowing)).alias("_r"))
        near = filled.select("_place", F.coalesce("_near", F.array_distinct(F.concat(F.coalesce("_l", F.array()), F.coalesce("_r", F.array())))).alias("_near"))
        joined = split(df, raw).join(near, F.col("_slot") == F.col("_place"), "left")
        low = F.array_max(F.filter("_near", lambda p: p["x"] <= F.col(raw)))
        high = F.array_min(F.filter("_near", lambda p: p["x"] > F.col(raw)))
        met = joined.withColumns({"_low": low, "_high": high})
        inside = F.col("_low.y") + (F.col("_high.y") - F.col("_low.y")) * (F.col(raw) - F.col("_low.x")) / (F.col("_high.x") - F.col("_low.x"))
        value = F.when(F.col("_low").isNull(), F.col("_high.y")).when(F.col("_high").isNull(), F.col("_low.y")).otherwise(inside)
        return met.withColumn(out, value).drop("_slot", "_place", "_near", "_low", "_high")


@dataclass(frozen=True)
class PlattCurve:
    """One-variable logistic calibrator."""

    slope: float
    intercept: float

    def add(self, df: DataFrame, raw: str, out: str) -> DataFrame:
        return df.withColumn(out, sigmoid(F.lit(self.intercept) + F.lit(self.slope) * F.col(raw)))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


# --- curves and bands as tables -----------------------------------------------------------
CURVE_SCHEMA = "kind string, x double, y double"
#: Points of a curve that may travel inside an expression.
LITERAL_POINTS = 10_000


def curve_frame(spark: SparkSession, curve: IsotonicCurve | IsotonicTable | PlattCurve | None) -> DataFrame:
    """A calibrator as rows: the points of a step curve, or slope and intercept."""
    if isinstance(curve, IsotonicTable):
        return curve.points.select(F.lit("isotonic").alias("kind"), "x", "y")
    if isinstance(curve, IsotonicCurve):
        rows = [("isotonic", float(x), float(y)) for x, y in zip(curve.boundaries, curve.predictions)]
    else:
        rows = [("platt", curve.slope, curve.intercept)] if curve else [("none", None, None)]
    return spark.createDataFrame(rows, CURVE_SCHEMA)


def step_curve(points: DataFrame, literal_points: int = LITERAL_POINTS) -> IsotonicCurve | IsotonicTable:
    """The curve through a written table of points: as literals where they are few, or else as the table."""
    if points.limit(literal_points + 1).count() > literal_points:
        return IsotonicTable(points)
    rows = sorted((r["x"], r["y"]) for r in points.collect())
    return IsotonicCurve([x for x, _ in rows], [y for _, y in rows])


def curve_of(table: DataFrame) -> IsotonicCurve | IsotonicTable | PlattCurve | None:
    first = table.first()
    if first["kind"] == "platt":
        return PlattCurve(first["x"], first["y"])
    return step_curve(table.select("x", "y")) if first["kind"] == "isotonic" else None


def band_frame(spark: SparkSession, bands: tuple) -> DataFrame:
    return spark.createDataFrame([(n, float(m), l) for n, m, l in bands], "name string, min_score double, label string")


def bands_of(table: DataFrame) -> tuple:
    return tuple((r["name"], r["min_score"], r["label"]) for r in sorted(table.collect(), key=lambda r: -r["min_score"]))


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Tables of a model, each a few rows, one file each."""
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


@dataclass(frozen=True)
class Scorecard:
    """Everything that turns an applicant into a decision, as plain numbers."""

    bins: WoeBins
    coefficients: dict[str, float]
    intercept: float
    calibrator: IsotonicCurve | IsotonicTable | PlattCurve | None = None
    scaling: ScoreScaling = field(default_factory=ScoreScaling)
    bands: tuple = DEFAULT_BANDS

    @property
    def features(self) -> list[str]:
        return list(self.coefficients)

    def with_calibrator(self, calibrator) -> Scorecard:
        return replace(self, calibrator=calibrator)

    # --- persistence: parameter tables, readable by any engine ---------------------------
    def save(self, spark: SparkSession, folder: str) -> None:
        write_tables({
            "coefficients": spark.createDataFrame([(i, f, b) for i, (f, b) in enumerate(self.coefficients.items())], "position int, feature string, beta double"),
            "bins": self.bins.to_frame(spark),
            "bin_table": self.bins.table(spark),
            "settings": spark.createDataFrame(
                [(self.intercept, self.scaling.base_score, self.scaling.base_odds, self.scaling.pdo)], "intercept double, base_score double, base_odds double, pdo double"
            ),
            "curve": curve_frame(spark, self.calibrator),
            "bands": band_frame(spark, self.bands),
        }, folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Scorecard:
        def read(name: str) -> DataFrame:
            return spark.read.parquet(f"{folder}/{name}")

        s = read("settings").first()
        betas = sorted(read("coefficients").collect(), key=lambda r: r["position"])
        return cls(
            WoeBins.from_frames(read("bins"), read("bin_table")), {r["feature"]: r["beta"] for r in betas}, s["intercept"],
            curve_of(read("curve")), ScoreScaling(s["base_score"], s["base_odds"], s["pdo"]), bands_of(read("bands")),
        )


def _require(df: DataFrame, features: list[str]) -> None:
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise KeyError(f"missing features {missing}")


def add_log_odds(df: DataFrame, card: Scorecard, out: str = "log_odds_bad") -> DataFrame:
    """Raw log-odds of bad: the intercept plus the WoE dot product."""
    _require(df, card.features)
    wide = woe_transform(df, card.bins, card.features)
    dot = total([F.lit(card.intercept), *[F.lit(b) * F.col(f"woe_{f}") for f, b in card.coefficients.items()]])
    return wide.withColumn(out, dot).drop(*[f"woe_{f}" for f in card.features])


def calibrated_pd(df: DataFrame, raw: str, calibrator, out: str = "probability_of_default") -> DataFrame:
    """Calibrated probability, kept off 0 and 1; the raw one when there is no calibrator."""
    if calibrator is None:
        return df.withColumn(out, F.col(raw))
    adjusted = calibrator.add(df, raw, out)
    return adjusted.withColumn(out, F.least(F.greatest(F.col(out), F.lit(PD_FLOOR)), F.lit(1.0 - PD_FLOOR)))


def score(df: DataFrame, card: Scorecard) -> DataFrame:
    """Add ``probability_of_default``, ``raw_score`` (from the raw log-odds, so it stays the
    sum of the points table), the half-even rounded ``score`` and the ``band`` of the
    unrounded score."""
    s = card.scaling
    scored = add_log_odds(df, card, "_logit").withColumn("_raw", sigmoid(F.col("_logit")))
    scored = calibrated_pd(scored, "_raw", card.calibrator)
    scored = scored.withColumn("raw_score", F.lit(s.offset) - F.lit(s.factor) * F.col("_logit"))
    return with_decision(scored, card.bands).drop("_logit", "_raw")


def with_decision(df: DataFrame, bands=DEFAULT_BANDS, raw_score: str = "raw_score") -> DataFrame:
    return df.withColumns({
        "score": F.bround(F.col(raw_score), 0).cast("bigint"),
        "band": assign_band(F.col(raw_score), bands),
    })


def decide(df: DataFrame, card: Scorecard, keep: list[str] | None = None) -> DataFrame:
    """Decisions only: the kept columns, PD, score and band.  Reads just the model's features."""
    keep = ["applicant_id"] if keep is None else keep
    narrow = df.select(*dict.fromkeys([*keep, *card.features]))
    return score(narrow, card).select(*keep, "probability_of_default", "score", "band")


def decision_struct(df: DataFrame, card: Scorecard, keep: list[str] | None = None) -> DataFrame:
    keep = ["applicant_id"] if keep is None else keep
    return decide(df, card, keep).select(*keep, F.struct("probability_of_default", "score", "band").alias("decision"))


def band_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("band").agg(F.count(F.lit(1)).alias("applicants")).orderBy("band")
