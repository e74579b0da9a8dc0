"""Model fits on Spark ML, on as few rows as give the same answer.

A WoE design matrix has few distinct rows, and a scorecard has few distinct scores: rows are
counted first and the fit is weighted, which leaves the likelihood as it was.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradus.functions.columns import DEFAULT_BANDS, MISSING_BIN, ScoreScaling, bin_index, literal, md5_int, number, quoted, with_row
from gradus.operators.boosting import Boosting
from gradus.operators.evaluation import auc_gini
from gradus.operators.isotonic import curve_points, pooled_blocks
from gradus.operators.ordering import melt, score_table
from gradus.operators.scoring import (
    IsotonicCurve, IsotonicTable, PlattCurve, Scorecard, band_frame, bands_of, calibrated_pd, curve_frame, curve_of, step_curve, with_decision, write_tables,
)
from gradus.operators.trees import ABSENT, Trees
from gradus.operators.woe import WoeBins
from gradus.sources.tables import materialise


def design_cells(train: DataFrame, bins: WoeBins, target: str) -> DataFrame:
    """Distinct (bin of every feature, target) with their row count and WoE values."""
    features = list(bins.features)
    cells = (
        train.select(F.col(target).cast("double").alias("label"), *[number(f).alias(f) for f in features])
        .select("label", *[bin_index(f, bins.features[f].edges).alias(f) for f in features])
        .groupBy("label", *features)
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )

    def woe_of(f: str):
        b = bins.features[f]
        steps = " ".join(f"WHEN {i} THEN {literal(w)}" for i, w in enumerate(b.woe))
        return F.expr(f"CASE {quoted(f)} WHEN {MISSING_BIN} THEN {literal(b.missing_woe)} {steps} END")

    return cells.select("label", "weight", *[woe_of(f).alias(f) for f in features])


def fit_logistic(df: DataFrame, features: list[str], label: str, weight: str, c: float = 1.0, max_iter: int = 2000):
    """L2 logistic regression with the usual ``C``; the intercept is not penalised.

    The loss is averaged here and summed in the ``C`` convention, hence 1 / (C * rows).
    """
    rows = df.agg(F.sum(weight)).first()[0]
    vector = VectorAssembler(inputCols=features, outputCol="_x").transform(df.select(label, weight, *features))
    return LogisticRegression(
        featuresCol="_x", labelCol=label, weightCol=weight, regParam=1.0 / (c * rows), elasticNetParam=0.0,
        standardization=False, tol=1e-9, maxIter=max_iter,
    ).fit(vector)


def fit_champion(train: DataFrame, bins: WoeBins, target: str, c: float = 1.0, max_iter: int = 2000, **card) -> Scorecard:
    features = list(bins.features)
    model = fit_logistic(materialise(design_cells(train, bins, target)), features, "label", "weight", c, max_iter)
    return Scorecard(bins, dict(zip(features, (float(v) for v in model.coefficients))), float(model.intercept), **card)


def fit_calibrator(df: DataFrame, p: str, y: str, method: str = "isotonic") -> IsotonicCurve | IsotonicTable | PlattCurve:
    """Post-hoc calibrator, fitted on counted scores rather than on rows."""
    table = score_table(df, p, y)
    if method == "isotonic":
        return step_curve(materialise(curve_points(pooled_blocks(table))))
    if method == "platt":
        goods = F.col("n") - F.col("bads")
        cells = table.select(
            F.col("p").alias("x"),
            F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("bads").cast("double").alias("weight")),
                              F.struct(F.lit(0.0).alias("label"), goods.cast("double").alias("weight")))).alias("c"),
        ).select("x", "c.label", "c.weight").where(F.col("weight") > 0)
        model = fit_logistic(materialise(cells), ["x"], "label", "weight", 1.0, 1000)
        return PlattCurve(float(model.coefficients[0]), float(model.intercept))
    raise ValueError(f"unknown calibration method: {method}")


# --- challenger ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Challenger:
    """Boosted trees on raw features, with calibrator and score scale."""

    trees: Trees
    calibrator: IsotonicCurve | IsotonicTable | PlattCurve | None = None
    scaling: ScoreScaling = ScoreScaling()
    bands: tuple = DEFAULT_BANDS

    @property
    def features(self) -> list[str]:
        return self.trees.features

    def raw_probability(self, df: DataFrame, out: str = "_raw") -> DataFrame:
        margined = self.trees.margin(df, "_margin")
        return margined.withColumn(out, self.trees.probability(F.col("_margin"))).drop("_margin")

    def score(self, df: DataFrame) -> DataFrame:
        """PD, score and band; the score is the scaled calibrated PD."""
        scored = calibrated_pd(self.raw_probability(df), "_raw", self.calibrator)
        scored = scored.withColumn("raw_score", self.scaling.to_score(F.col("probability_of_default")))
        return with_decision(scored, self.bands).drop("_raw")

    def save(self, spark: SparkSession, folder: str) -> None:
        """Parameter tables, readable by any engine: nodes, features, curve, scale and bands."""
        write_tables({
            "nodes": self.trees.to_frame(spark),
            "features": spark.createDataFrame(list(enumerate(self.features)), "position int, feature string"),
            "curve": curve_frame(spark, self.calibrator),
            "settings": spark.createDataFrame([(self.scaling.base_score, self.scaling.base_odds, self.scaling.pdo)], "base_score double, base_odds double, pdo double"),
            "bands": band_frame(spark, self.bands),
        }, folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Challenger:
        def read(name: str) -> DataFrame:
            return spark.read.parquet(f"{folder}/{name}")

        features = [r["feature"] for r in sorted(read("features").collect(), key=lambda r: r["position"])]
        s = read("settings").first()
        return cls(Trees.from_frame(read("nodes"), features), curve_of(read("curve")), ScoreScaling(s["base_score"], s["base_odds"], s["pdo"]), bands_of(read("bands")))


def tree_vector(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature vector for trees.  A missing value sits left of every other one, so a split
    can set it apart."""
    filled = df.withColumn(
        "_filled", F.struct(*[F.coalesce(number(f), F.lit(ABSENT)).alias(f) for f in features])
    )
    flat = filled.select(*df.columns, *[F.col(f"_filled.{f}").alias(f"_f_{f}") for f in features])
    return (
        VectorAssembler(inputCols=[f"_f_{f}" for f in features], outputCol="_x").transform(flat).drop(*[f"_f_{f}" for f in features])
    )


#: Training rows up to which the library's own boosted fit is taken; above, trees grow on blocks.
LIBRARY_ROWS = 250_000


def rounds_to_keep(losses: list[float], patience: int) -> int | None:
    """Round (from 1) of the least loss, once ``patience`` rounds have passed without a lower one; None before."""
    best = min(range(len(losses)), key=losses.__getitem__)
    return best + 1 if len(losses) - 1 - best >= patience else None


def fit_challenger(
    train: DataFrame,
    valid: DataFrame,
    features: list[str],
    target: str,
    max_iter: int = 400,
    patience: int = 40,
    max_depth: int = 4,
    step: float = 0.05,
    subsample: float = 0.9,
    column_sample: str = "0.8",
    min_instances: int = 20,
    seed: int = 42,
) -> Challenger:
    """Boosted trees; the round of the least validation loss within ``patience`` is kept.

    Spark's own early stop ends at the first round that gains too little.  Here rounds are
    doubled until the loss on ``valid``, read after every round, has not improved for
    ``patience`` of them (or ``max_iter`` is reached); a second doubling fits all of them.  The
    trees up to the best round are the model of that many rounds: none depends on later ones.
    Above ``LIBRARY_ROWS`` rows the trees grow on blocks, by the same method and rule, and go on
    from where they stand instead of being fitted again.
    """
    if train.count() > LIBRARY_ROWS:
        grown, seen, best = Boosting(train, valid, features, F.col(target), max_depth, step, subsample, column_sample, min_instances, seed), 0, None
        while best is None and seen < max_iter:
            seen = min(max_iter, 2 * seen or max(1, 2 * patience))
            best = rounds_to_keep(grown.to(seen), patience)
        return Challenger(grown.model(best or 1 + min(range(seen), key=grown.losses.__getitem__)))
    vectors = {
        name: materialise(tree_vector(df.select(*features, target), features).select("_x", F.col(target).cast("double").alias("label")))
        for name, df in (("train", train), ("valid", valid))
    }

    def boosted(rounds: int) -> GBTClassificationModel:
        return GBTClassifier(
            featuresCol="_x", labelCol="label", maxIter=rounds, maxDepth=max_depth, stepSize=step, subsamplingRate=subsample,
            featureSubsetStrategy=column_sample, minInstancesPerNode=min_instances, seed=seed,
        ).fit(vectors["train"])

    seen, fitted = 0, 0
    while True:
        seen = min(max_iter, 2 * seen or max(1, 2 * patience))
        if seen > fitted:
            fitted = seen if seen <= 4 * patience else max_iter
            model = boosted(fitted)
            losses = model.evaluateEachIteration(vectors["valid"])
        best = rounds_to_keep(losses[:seen], patience)
        if best is not None or seen == max_iter:
            best = best or 1 + min(range(seen), key=losses.__getitem__)
            break
    return Challenger(Trees.of(model, features).first(best))


def permutation_importance(
    df: DataFrame,
    features: list[str],
    target: str,
    id_col: str,
    raw_probability,
    seed: int = 42,
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """AUC lost when one feature is replaced by that of another row.

    The donor row is the next one in a hashed order of all rows, the last takes the first.
    Ranges of the hash split the work, and the first row of each range serves the range before,
    so the numbers don't depend on ``rows_per_bucket``.  ``raw_probability(df, out)`` scores
    every variant in the same pass.
    """
    n = df.count()
    buckets = max(1, -(-n // rows_per_bucket))
    key = md5_int(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))), 15)
    placed = df.select(id_col, target, *features).withColumns({"_key": key}).withColumn("_bucket", F.expr(f"_key div {-(-(16**15) // buckets)}"))
    w = Window.partitionBy("_bucket").orderBy("_key", id_col)
    row = F.struct(*features)
    # The first row of each range: one row per range, and the first of all after the last.
    firsts = placed.groupBy("_bucket").agg(F.min(F.struct("_key", F.col(id_col).alias("_id"), row.alias("row"))).alias("first"))
    ring = Window.partitionBy(F.lit(0)).orderBy("_bucket")
    around = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    served = firsts.select(F.col("_bucket").alias("_s_bucket"), F.coalesce(F.lead("first.row").over(ring), F.first("first.row").over(around)).alias("_after"))
    donors = placed.withColumn("_lead", F.lead(row).over(w)).join(served, F.col("_bucket") == F.col("_s_bucket"))
    donors = donors.withColumn("_donor", F.coalesce("_lead", "_after"))
    cells = {"(none)": [F.col(f) for f in features]}
    for f in features:
        cells[f] = [F.col(f"_donor.{f}") if g == f else F.col(g) for g in features]
    variants = melt(donors, [target], {f"v{i}": c for i, c in enumerate(cells.values())}, features)
    names = F.create_map(*[x for i, name in enumerate(cells) for x in (F.lit(f"v{i}"), F.lit(name))])
    scored = raw_probability(variants.withColumnRenamed("feature", "_variant"), "_p")
    auc = materialise(auc_gini(scored, "_p", target, by=["_variant"]).select(F.element_at(names, F.col("_variant")).alias("feature"), "auc"))
    base = auc.where(F.col("feature") == "(none)").select(F.col("auc").alias("base_auc"))
    return (
        with_row(auc.where(F.col("feature") != "(none)"), base)
        .select("feature", F.col("auc").alias("permuted_auc"), (F.col("base_auc") - F.col("auc")).alias("auc_loss"))
    )
