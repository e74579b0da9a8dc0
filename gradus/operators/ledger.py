"""Transaction ledgers: behaviour per merchant, merchant holdout, affordability."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.functions.columns import md5_int, merchant_stem, total
from gradus.operators.ordering import grouped_median, running_totals
from gradus.sources.tables import materialise

# Spend a lender treats as committed, and as optional.
ESSENTIAL = ("groceries", "housing", "transport", "utilities")
DISCRETIONARY = ("eating_out", "shopping", "subscriptions")

BEHAVIOUR = [
    "abs_amount_log", "is_credit", "day_of_month", "merchant_frequency", "merchant_amount_cv", "merchant_is_monthly",
    "share_of_month_outflow",
]


def outflow(amount: Column) -> Column:
    return F.when(amount < 0, -amount).otherwise(F.lit(0.0))


def with_stem(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("merchant_stem", merchant_stem(F.col("description")))


def _cv(std: Column, mean: Column) -> Column:
    return F.try_divide(std, mean)


def behavioural_features(ledger: DataFrame) -> DataFrame:
    """Transaction-shape features of every row.

    Group statistics are aggregated (combined on the map side) and joined back, rather than
    computed in a window: a merchant or account with a third of all rows is then a skewed
    join side, which adaptive execution splits, not one task's window.
    """
    rows = with_stem(ledger).withColumn("_month", F.expr("day div 30"))
    merchant = rows.groupBy("applicant_id", "merchant_stem").agg(
        F.count(F.lit(1)).alias("merchant_frequency"),
        F.abs(F.avg("amount")).alias("_mean"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("_std"),
    ).select(
        "applicant_id", "merchant_stem", "merchant_frequency",
        F.coalesce(_cv(F.col("_std"), F.col("_mean")), F.lit(0.0)).alias("merchant_amount_cv"),
    )
    month = rows.groupBy("applicant_id", "_month").agg(F.sum(outflow(F.col("amount"))).alias("_month_outflow"))
    return (
        rows.join(merchant, ["applicant_id", "merchant_stem"], "left")
        .join(month, ["applicant_id", "_month"], "left")
        .withColumns({
            "abs_amount_log": F.log1p(F.abs("amount")),
            "is_credit": (F.col("amount") > 0).cast("double"),
            "day_of_month": F.pmod(F.col("day"), F.lit(30)),
            "merchant_is_monthly": (F.col("merchant_frequency").between(4, 8) & (F.col("merchant_amount_cv") < 0.25)).cast("double"),
            "share_of_month_outflow": F.coalesce(F.try_divide(F.abs("amount"), F.col("_month_outflow")), F.lit(0.0)),
        })
        .drop("_month", "_month_outflow")
    )


# --- merchant holdout ---------------------------------------------------------------------
def holdout_merchants(ledger: DataFrame, seed: int = 7, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """A quarter of each category's merchants (at least one), for categories with over two.

    Merchants are ordered by a hash of their name; the running count finds the first
    quarter without sorting a whole category in one task.
    """
    stems = materialise(
        with_stem(ledger).groupBy("true_category", "merchant_stem").agg(F.lit(1).cast("bigint").alias("one"))
        .withColumn("_key", md5_int(F.concat_ws("|", "merchant_stem", F.lit(str(seed))), 15))
    )
    ranked = running_totals(stems, "_key", ["one"], by=["true_category"], ties=["merchant_stem"], rows_per_bucket=rows_per_bucket)
    sizes = stems.groupBy("true_category").agg(F.sum("one").alias("merchants"))
    return (
        ranked.join(sizes, "true_category")
        .where((F.col("merchants") > 2) & (F.col("cum_one") <= F.greatest(F.lit(1), F.expr("merchants div 4"))))
        .select("true_category", "merchant_stem")
    )


def split_by_merchant(ledger: DataFrame, held_out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test): test rows belong to a held-out merchant, whatever their category."""
    names = held_out.select("merchant_stem").distinct()
    rows = ledger if "merchant_stem" in ledger.columns else with_stem(ledger)
    return rows.join(names, "merchant_stem", "left_anti"), rows.join(names, "merchant_stem", "left_semi")


def baselines(test: DataFrame, categories: int) -> DataFrame:
    """Accuracy of guessing the test set's largest class, and of guessing at random."""
    counts = test.groupBy("true_category").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        (F.max("n").cast("double") / F.sum("n").cast("double")).alias("majority_class_baseline"),
        F.lit(1.0 / categories).alias("uniform_baseline"), F.sum("n").alias("test_rows"),
    )


# --- affordability ------------------------------------------------------------------------
def cashflow_features(ledger: DataFrame, months: int = 6, category: str = "category") -> DataFrame:
    """The 18 affordability features of each applicant.

    One aggregate keyed by applicant (partial sums first, so a busy account is combined
    before the shuffle; its overdrawn days are made distinct on (account, day) first) plus
    the income median, which is found on counted payments.
    """
    amount, kind = F.col("amount"), F.col(category)
    month = F.least(F.expr("day div 30"), F.lit(months - 1))
    rows = ledger.select("applicant_id", "day", "amount", "balance_after", kind.alias("_kind"), outflow(amount).alias("_out"), month.alias("_month"))
    income = F.when(F.col("_kind") == "income", amount)

    def spent(*kinds: str) -> Column:
        return F.sum(F.when(F.col("_kind").isin(*kinds), F.col("_out")))

    sums = materialise(rows.groupBy("applicant_id").agg(
        F.count(income).alias("_payments"), F.avg(income).alias("_income_mean"), F.stddev_samp(income).alias("_income_std"),
        F.sum("_out").alias("_total_out"), spent(*ESSENTIAL).alias("_essential"), spent(*DISCRETIONARY).alias("_discretionary"),
        *[spent(k).alias(f"_{k}") for k in ("debt_repayment", "cash", "fees")],
        F.count_if(F.col("_kind") == "fees").alias("_fee_events"),
        F.min("balance_after").alias("ob_min_balance"), F.avg("balance_after").alias("ob_mean_balance"),
        F.count_distinct(F.when(F.col("balance_after") < 0, F.col("day"))).alias("_overdrawn"),
        # NULL, not 0, for a month without rows: that tells which months the data has at all.
        *[F.sum(F.when(F.col("_month") == m, F.col("_out"))).alias(f"_m{m}") for m in range(months)],
    ))
    present = sums.agg(*[F.count(f"_m{m}").alias(f"_m{m}") for m in range(months)]).first()
    by_month = [F.coalesce(F.col(f"_m{m}"), F.lit(0.0)) for m in range(months) if present[f"_m{m}"]]
    median = grouped_median(rows.where(F.col("_kind") == "income"), ["applicant_id"], "amount", "ob_income_monthly_median")
    mean = total(by_month) / F.lit(float(len(by_month))) if by_month else F.lit(None).cast("double")
    spread = (
        F.sqrt(total([(m - F.col("_month_mean")) * (m - F.col("_month_mean")) for m in by_month]) / F.lit(float(len(by_month) - 1)))
        if len(by_month) > 1 else F.lit(None).cast("double")
    )
    fixed = float(months)
    joined = sums.join(median, "applicant_id", "left").withColumn("_month_mean", mean)
    volatility = F.try_divide(F.col("_income_std"), F.col("_income_mean"))
    essential = F.col("_essential") / F.lit(fixed)
    return joined.select(
        "applicant_id",
        "ob_income_monthly_median",
        F.when(F.col("_payments") > 0, F.col("_payments")).alias("ob_income_payment_count"),
        volatility.alias("ob_income_volatility"),
        F.coalesce((volatility < 0.15).cast("double"), F.lit(0.0)).alias("ob_income_is_regular"),
        essential.alias("ob_essential_spend_monthly"),
        F.coalesce(F.try_divide(F.col("_essential"), F.col("_total_out")), F.lit(0.0)).alias("ob_essential_spend_ratio"),
        (F.col("_discretionary") / F.lit(fixed)).alias("ob_discretionary_spend_monthly"),
        F.coalesce(F.try_divide(F.col("_discretionary"), F.col("_total_out")), F.lit(0.0)).alias("ob_discretionary_spend_ratio"),
        *[(F.coalesce(F.col(f"_{k}"), F.lit(0.0)) / F.lit(fixed)).alias(f"ob_{k}_monthly") for k in ("debt_repayment", "cash", "fees")],
        F.col("_fee_events").cast("double").alias("ob_fee_events"),
        "ob_min_balance", "ob_mean_balance",
        F.col("_overdrawn").cast("double").alias("ob_days_in_overdraft"),
        (F.coalesce(F.col("ob_income_monthly_median"), F.lit(0.0)) - F.coalesce(essential, F.lit(0.0))).alias("ob_surplus_after_essentials"),
        F.try_divide(F.col("ob_income_monthly_median"), essential).alias("ob_essential_cover_ratio"),
        F.try_divide(spread, F.col("_month_mean")).alias("ob_spend_volatility"),
    )


def ledger_expectations(ledger: DataFrame, category: str = "true_category") -> DataFrame:
    """Sign and coverage rules of a ledger as ``check, violations, passed`` rows."""
    kind = F.col(category)
    per_applicant = ledger.groupBy("applicant_id").agg(
        F.count_if((kind == "income") & (F.col("amount") <= 0)).alias("income_sign"),
        F.count_if((kind != "income") & (F.col("amount") >= 0)).alias("spend_sign"),
        F.count_if(kind == "income").alias("incomes"), F.count_if(kind.isin(*ESSENTIAL)).alias("essentials"),
        F.min("balance_after").alias("lowest"), F.count_if(F.col("balance_after") < 0).alias("overdrawn"),
    )
    one = per_applicant.agg(
        F.sum("income_sign").alias("income_is_positive"), F.sum("spend_sign").alias("spend_is_negative"),
        F.count_if(F.col("incomes") == 0).alias("every_applicant_has_income"),
        F.count_if(F.col("essentials") == 0).alias("every_applicant_has_essentials"),
        F.count_if((F.col("overdrawn") > 0) != (F.col("lowest") < 0)).alias("overdraft_matches_lowest_balance"),
    )
    return one.unpivot([], one.columns, "check", "violations").withColumn("passed", F.col("violations") == 0)


def track_summary(
    ledger: DataFrame, held_out: DataFrame, metrics: list[DataFrame], accuracies: dict[str, DataFrame] | None = None, features: list[str] | None = None
) -> DataFrame:
    """``metric, value`` rows: counts of the transaction track, given rows, the named accuracies (each a table with an
    ``accuracy``), and the derived features with their places."""
    per_applicant = ledger.groupBy("applicant_id").agg(F.count(F.lit(1)).alias("n"))
    counts = per_applicant.agg(F.count(F.lit(1)).cast("double").alias("applicants"), F.sum("n").cast("double").alias("transactions"))
    kinds = ledger.groupBy("true_category").agg(F.lit(1).alias("one")).agg(F.count(F.lit(1)).cast("double").alias("n_categories"))
    months = ledger.agg((F.floor(F.max("day") / 30) + 1).cast("double").alias("months_of_history"))
    held = held_out.agg(F.count(F.lit(1)).cast("double").alias("held_out_merchants"))
    parts = [t.unpivot([], t.columns, "metric", "value") for t in (counts, kinds, months, held)]
    parts += [t.select(F.lit(name).alias("metric"), F.col("accuracy").cast("double").alias("value")) for name, t in (accuracies or {}).items()]
    if features:
        rows = [(f"feature {name}", float(place)) for place, name in enumerate(features, 1)]
        parts.append(ledger.sparkSession.createDataFrame(rows, "metric string, value double"))
    return reduce(DataFrame.unionByName, [*parts, *metrics])


def summary_document(summary: DataFrame) -> DataFrame:
    """The summary as one JSON document: numbers by name, and the features as a list."""
    place = F.when(F.col("metric").startswith("feature "), F.struct(F.col("value").alias("place"), F.substring_index("metric", " ", -1).alias("name")))
    number = F.when(~F.col("metric").startswith("feature "), F.struct(F.col("metric").alias("key"), F.col("value").alias("value")))
    both = summary.agg(F.array_sort(F.collect_list(number)).alias("numbers"), F.array_sort(F.collect_list(place)).alias("places"))
    return both.select(F.to_json(F.struct(F.map_from_entries("numbers").alias("metrics"), F.col("places.name").alias("features"))).alias("document"))
