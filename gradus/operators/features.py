"""Gold: one feature derivation used by the batch build, by replay and by streams."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradus.functions.columns import age_band, md5_int, number
from gradus.operators.ordering import melt, quantiles

TARGET = "target_default_90dpd_2yr"

# The model inputs, in their published order.
MODEL_FEATURES = [
    "revolving_utilisation",
    "age",
    "debt_ratio",
    "monthly_income",
    "open_credit_lines",
    "real_estate_lines",
    "dependents",
    "times_30_59_dpd",
    "times_60_89_dpd",
    "times_90_dpd",
    "monthly_debt_amount",
    "total_delinquencies",
    "worst_delinquency_severity",
    "delinquencies_per_credit_line",
    "unsecured_lines",
    "real_estate_share_of_lines",
    "monthly_debt_service",
    "disposable_income",
    "income_per_dependent",
    "log_monthly_income",
    "utilisation_x_delinquency",
    "flag_delinquency_sentinel",
    "flag_monthly_income_missing",
    "flag_debt_ratio_is_amount",
]
RAW_INPUTS = [
    "revolving_utilisation", "age", "debt_ratio", "monthly_income", "open_credit_lines", "real_estate_lines",
    "dependents", "times_30_59_dpd", "times_60_89_dpd", "times_90_dpd",
]
CLEAN_FLAGS = ["flag_delinquency_sentinel", "flag_monthly_income_missing", "flag_debt_ratio_is_amount"]


@dataclass(frozen=True)
class ImputationConstants:
    """What the batch build filled gaps with; replayed when there is no population."""

    income_by_band: dict[str, float] = field(default_factory=dict)
    income: float = 5000.0
    age: float = 52.0
    debt_ratio: float = 0.35
    dependents: float = 0.0
    monthly_debt_amount: float = 0.0

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """Constants as rows: ``constant, age_band, value``."""
        rows = [("monthly_income_by_age_band", b, v) for b, v in sorted(self.income_by_band.items())]
        rows += [
            ("monthly_income_global_median", None, self.income),
            ("age_median", None, self.age),
            ("debt_ratio_median", None, self.debt_ratio),
            ("dependents_fill", None, self.dependents),
            ("monthly_debt_amount_fill", None, self.monthly_debt_amount),
        ]
        return spark.createDataFrame(rows, "constant string, age_band string, value double")

    @classmethod
    def from_frame(cls, df: DataFrame) -> ImputationConstants:
        rows = df.collect()
        one = {r["constant"]: r["value"] for r in rows if r["age_band"] is None}
        return cls(
            {r["age_band"]: r["value"] for r in rows if r["age_band"] is not None},
            one["monthly_income_global_median"], one["age_median"], one["debt_ratio_median"],
            one["dependents_fill"], one["monthly_debt_amount_fill"],
        )

    def as_dict(self) -> dict:
        return asdict(self)


def fit_constants(silver: DataFrame, fit_on: Column | None = None) -> ImputationConstants:
    """Medians that are values of the data, over all rows or over ``fit_on`` only."""
    base = silver if fit_on is None else silver.where(fit_on)
    # Every row counts once for the whole table (NULL scope) and once for its band, so one
    # pass finds both kinds of median.
    base = base.select(
        "age", "debt_ratio", "monthly_income", F.explode(F.array(F.lit(None).cast("string"), age_band(F.col("age")))).alias("scope")
    )
    whole_only = {c: F.when(F.col("scope").isNull(), F.col(c)) for c in ("age", "debt_ratio")}
    cells = quantiles(base.withColumns(whole_only), ["monthly_income", "age", "debt_ratio"], [0.5], method="lower", by="scope")

    def middle(column: str, default: float) -> float:
        cell = cells.get((None, column))
        return cell.values[0.5] if cell and cell.n else default

    income = middle("monthly_income", 5000.0)
    # A band with no income at all is filled with the global median, so that is its median.
    by_band = {band: (cell.values[0.5] if cell.n else income) for (band, c), cell in cells.items() if band is not None and c == "monthly_income"}
    return ImputationConstants(by_band, income, middle("age", 52.0), middle("debt_ratio", 0.35))


def credit_mix(df: DataFrame) -> DataFrame:
    """Arrears profile and credit mix.  A missing counter counts as 0 in the totals only."""
    d30, d60, d90 = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("times_30_59_dpd", "times_60_89_dpd", "times_90_dpd"))
    lines, property_lines = F.col("open_credit_lines").cast("double"), F.col("real_estate_lines").cast("double")
    at_least_one = F.greatest(lines, F.lit(1.0))
    return df.withColumns({
        "total_delinquencies": d30 + d60 + d90,
        "worst_delinquency_severity": F.when(d90 > 0, 3.0).when(d60 > 0, 2.0).when(d30 > 0, 1.0).otherwise(0.0),
        "delinquencies_per_credit_line": (d30 + d60 + d90) / at_least_one,
        "unsecured_lines": F.greatest(lines - property_lines, F.lit(0.0)),
        "real_estate_share_of_lines": property_lines / at_least_one,
    })


def impute(df: DataFrame, constants: ImputationConstants) -> DataFrame:
    """Fill gaps from constants.  The band is taken before the age itself is filled."""
    band = age_band(F.col("age"))
    by_band = F.lit(None).cast("double")
    for name, value in sorted(constants.income_by_band.items()):
        by_band = F.when(band == name, F.lit(float(value))).otherwise(by_band)
    return df.withColumns({
        "age_band": band,
        "monthly_income": F.coalesce(F.col("monthly_income"), by_band, F.lit(float(constants.income))),
        "age": F.coalesce(F.col("age"), F.lit(float(constants.age))),
        "dependents": F.coalesce(F.col("dependents"), F.lit(float(constants.dependents))),
        "debt_ratio": F.coalesce(F.col("debt_ratio"), F.lit(float(constants.debt_ratio))),
        "monthly_debt_amount": F.coalesce(F.col("monthly_debt_amount"), F.lit(float(constants.monthly_debt_amount))),
    })


def affordability(df: DataFrame) -> DataFrame:
    income, ratio = F.col("monthly_income"), F.col("debt_ratio")
    return df.withColumns({
        "monthly_debt_service": income * ratio,
        "disposable_income": income - income * ratio,
        "income_per_dependent": income / (F.lit(1.0) + F.col("dependents")),
        "log_monthly_income": F.log1p(F.greatest(income, F.lit(0.0))),
        "utilisation_x_delinquency": F.col("revolving_utilisation") * (F.lit(1.0) + F.col("total_delinquencies")),
    })


def derive_features(applicants: DataFrame, constants: ImputationConstants) -> DataFrame:
    """All derived features for any applicants, batch or stream: no shuffle, no population.

    Raw inputs that are absent become NULL, absent flags become 0, an absent amount 0.
    """
    given = set(applicants.columns)
    inputs = {c: number(c) if c in given else F.lit(None).cast("double") for c in RAW_INPUTS}
    inputs["monthly_debt_amount"] = number("monthly_debt_amount") if "monthly_debt_amount" in given else F.lit(0.0)
    for flag in CLEAN_FLAGS:
        if flag not in given:
            inputs[flag] = F.lit(0)
    return affordability(impute(credit_mix(applicants.withColumns(inputs)), constants))


def hash_split(
    df: DataFrame,
    id_col: str = "applicant_id",
    seed: int = 42,
    fractions: tuple[float, float] = (0.6, 0.2),
    method: str = "murmur3",
) -> DataFrame:
    """Assign train/valid/test from a hash of the id, so no rebuild can move an applicant.

    ``murmur3`` is Spark's own hash; ``md5`` gives the same split in any engine.
    """
    text = F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed)))
    if method == "murmur3":
        bucket = F.pmod(F.hash(text), F.lit(1000))
    elif method == "md5":
        bucket = md5_int(text) % 1000
    else:
        raise ValueError(f"unknown split method: {method}")
    train, valid = int(fractions[0] * 1000), int((fractions[0] + fractions[1]) * 1000)
    return df.withColumn("split", F.when(bucket < train, "train").when(bucket < valid, "valid").otherwise("test"))


def build_gold(
    silver: DataFrame, constants: ImputationConstants | None = None, seed: int = 42, split_method: str = "murmur3"
) -> DataFrame:
    """Gold: derived features, split and the explicit model columns."""
    constants = fit_constants(silver) if constants is None else constants
    gold = hash_split(derive_features(silver, constants), seed=seed, method=split_method)
    keep = ["applicant_id", TARGET, "split", "age_band", *MODEL_FEATURES]
    return gold.select(*[c for c in keep if c in gold.columns])


def parity(
    left: DataFrame, right: DataFrame, id_col: str, columns: list[str], tolerance: float = 1e-6, exempt: tuple[str, ...] = ()
) -> DataFrame:
    """Feature-by-feature difference of two tables on the same ids (both NULL = equal)."""
    columns = [c for c in columns if c not in exempt]
    a = left.select(id_col, *[F.col(c).cast("double").alias(f"a_{c}") for c in columns])
    b = right.select(id_col, *[F.col(c).cast("double").alias(f"b_{c}") for c in columns])
    cells = {c: [F.col(f"a_{c}"), F.col(f"b_{c}")] for c in columns}
    both = melt(a.join(b, id_col), [], cells, ["a", "b"])
    one_null = F.col("a").isNull() != F.col("b").isNull()
    return (
        both.groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("compared"),
            F.count_if(one_null).alias("null_mismatches"),
            F.coalesce(F.max(F.abs(F.col("a") - F.col("b"))), F.lit(0.0)).alias("max_abs_difference"),
        )
        .withColumn("within_tolerance", (F.col("null_mismatches") == 0) & (F.col("max_abs_difference") <= tolerance))
    )
