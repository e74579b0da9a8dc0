"""Credit-shaped views over the retail test tables (see FIXTURES.md).

Money and ratios are summed as integers and divided once, so any engine gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradus.functions.columns import md5_int

DUPLICATE_ID_OFFSET = 1_000_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def applications_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per order, with the planted defects of a bureau extract."""
    line = _table(spark, sf_dir, "lineitem")
    flag, status, qty = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    per_order = line.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.rint(F.col("l_discount") * 100).cast("int")).alias("disc"),
        F.sum(F.rint(F.col("l_tax") * 100).cast("int")).alias("tax"),
        F.count_if((flag == "R") & (status == "F")).alias("d30"),
        F.count_if((flag == "R") & (status == "O") & (qty > 35)).alias("d60"),
        F.count_if((flag == "A") & (qty > 45)).alias("d90"),
    )
    counts = ["n", "disc", "tax", "d30", "d60", "d90"]
    k, c, n, disc = F.col("k"), F.col("c"), F.col("n"), F.col("disc")
    base = (
        _table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), "o_totalprice")
        # The shuffle a sort-merge join needs anyway; it also spreads a one-split file when the
        # other side turns out small enough to broadcast.
        .repartition("k")
        .join(per_order, "k", "left")
        .withColumns({x: F.coalesce(F.col(x), F.lit(0)) for x in counts})
    )
    risk = (
        F.lit(20)
        + F.when(n == 0, F.lit(0.0)).otherwise(F.lit(15.0) * disc / F.greatest(n, F.lit(1)))
        + 60 * F.col("d30") + 80 * F.col("d60") + 120 * F.col("d90")
    )
    no_income = k % 5 == 2
    sentinel = k % 500 == 11
    texts = [F.array(*[x.cast("string") for x in xs]) for xs in ([k, k + DUPLICATE_ID_OFFSET], [k])]
    ids = F.when(k % 250 == 0, texts[0]).otherwise(texts[1])

    def counter(name: str):
        return F.when(sentinel, F.lit(98)).otherwise(F.col(name)).cast("string").alias({"d30": "times_30_59_dpd", "d60": "times_60_89_dpd", "d90": "times_90_dpd"}[name])

    return base.select(
        F.explode(ids).alias("applicant_id"),
        F.when(md5_int(k.cast("string")) % 1000 < risk, 1).otherwise(0).cast("string").alias("target_default_90dpd_2yr"),
        F.when(k % 400 == 7, F.lit(50708.0)).when(n == 0, F.lit(0.0))
        .otherwise(disc.cast("double") / (10 * F.greatest(n, F.lit(1)))).cast("string").alias("revolving_utilisation"),
        F.when(k % 3000 == 3, F.lit(0)).otherwise(18 + c % 70).cast("string").alias("age"),
        counter("d30"),
        F.when(no_income & (k % 4 != 0), (150 + k % 5000).cast("double")).otherwise(F.col("tax") / F.lit(8.0))
        .cast("string").alias("debt_ratio"),
        F.when(no_income, F.lit("NA")).otherwise((F.col("o_totalprice") / F.lit(50.0)).cast("string")).alias("monthly_income"),
        (n + k % 10).cast("string").alias("open_credit_lines"),
        counter("d90"),
        (k % 3).cast("string").alias("real_estate_lines"),
        counter("d60"),
        F.when(k % 40 == 9, F.lit("NA")).otherwise((c % 6).cast("string")).alias("dependents"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, p, y, seg): 32 distinct scores, so ties are heavy on purpose."""
    key = F.col("o_orderkey").cast("string")

    def draw(salt: str):
        return md5_int(F.concat_ws("|", key, F.lit(salt)))

    pm = 20 + F.expr("(60 * u) div 16") + F.when(F.col("v") == 0, 400).otherwise(0)
    return (
        _table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("seg"),
            (draw("p") % 16).alias("u"),
            (draw("p") % 11).alias("v"),
            (draw("y") % 1000).alias("w"),
        )
        .withColumn("pm", pm)
        .select("id", (F.col("pm").cast("double") / F.lit(1000.0)).alias("p"), F.when(F.col("w") < F.col("pm"), 1).otherwise(0).alias("y"), "seg")
    )


def ledger(spark: SparkSession, sf_dir: str, with_balance: bool = False) -> DataFrame:
    """Transactions from the event stream: 30 days stretched over six 30-day months."""
    e = _table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    category = (
        F.when(kind == "signup", "income")
        .when(kind == "click", F.when(F.col("k") % 2 == 0, "groceries").otherwise("transport"))
        .when(kind == "view", F.when(F.col("k") % 2 == 0, "eating_out").otherwise("shopping"))
        .when(kind == "purchase", F.when(F.col("k") % 3 == 0, "housing").when(F.col("k") % 3 == 1, "utilities").otherwise("subscriptions"))
        .when(kind == "error", F.when(F.col("k") % 4 == 0, "cash").when(F.col("k") % 4 == 1, "debt_repayment").when(F.col("k") % 4 == 2, "fees").otherwise("transfers"))
    )
    # A difference of two local times, so the session's time zone does not matter.
    opened = F.lit("2024-01-01").cast("timestamp_ntz").cast("timestamp")
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(opened)) / F.lit(1000000.0)
    cents = F.rint(F.col("value") * 100).cast("bigint")
    rows = (
        e.select("event_id", "user_id", "ts", "event_type", cents.alias("raw_cents"), k.alias("k"), seconds.alias("sec"))
        .withColumn("true_category", category)
        .select(
            F.col("user_id").alias("applicant_id"),
            F.floor(F.col("sec") / F.lit(86400.0) * F.lit(6.0)).cast("int").alias("day"),
            F.concat_ws(" ", F.upper("true_category"), F.char(65 + F.col("k") % 5), (1000 + F.col("k")).cast("string")).alias("description"),
            F.when(F.col("true_category") == "income", 4 * F.col("raw_cents")).otherwise(-F.col("raw_cents")).alias("cents"),
            "true_category",
            F.col("event_id").alias("transaction_id"),
        )
    )
    if with_balance:
        rows = _with_balance(rows)
    return rows.withColumn("amount", F.col("cents").cast("double") / F.lit(100.0))


def _with_balance(rows: DataFrame) -> DataFrame:
    """Account balance after each transaction, from an opening 200.00.

    Two levels, so that a hot account is summed over its days in parallel: totals per
    (account, day), their running sum as an opening balance, then order within the day.
    """
    daily = rows.groupBy("applicant_id", "day").agg(F.sum("cents").alias("moved"))
    earlier = Window.partitionBy("applicant_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    opening = daily.select(
        "applicant_id", "day", (F.lit(20000) + F.coalesce(F.sum("moved").over(earlier), F.lit(0))).alias("opening")
    )
    within = Window.partitionBy("applicant_id", "day").orderBy("transaction_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(opening, ["applicant_id", "day"])
        .withColumn("balance_after", (F.col("opening") + F.sum("cents").over(within)).cast("double") / F.lit(100.0))
        .drop("opening")
    )


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(reference, current): orders before and from 1998, with a continuous value, a
    zero-inflated counter, a counter that drifts, and the score."""
    key = F.col("id")
    arrears = F.when(key % 20 == 0, 1 + key % 3).otherwise(0)
    recent = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    rows = (
        scored(spark, sf_dir)
        .join(_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice", "o_orderdate"), "id")
        .select(
            "id", "p", F.col("o_totalprice").alias("price"), arrears.cast("double").alias("arrears"),
            F.when(recent & (key % 2 == 0), 5).otherwise(arrears).cast("double").alias("arrears_drifted"), recent.alias("recent"),
        )
    )
    return rows.where(~F.col("recent")).drop("recent"), rows.where("recent").drop("recent")
