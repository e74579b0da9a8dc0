"""Write, audit, publish: what readers see, and what joins of published tables cost."""

import uuid

import pytest
from pyspark.sql import functions as F

from gradus.operators import ledger as lg
from gradus.operators.features import ImputationConstants, derive_features
from gradus.operators.quality import gold_expectations
from gradus.operators.scoring import Scorecard, decide
from gradus.operators.woe import woe_fit
from gradus.plans import lake, monitoring
from gradus.sources import published, tables

TARGET = "target_default_90dpd_2yr"


def some_gold(spark, n, bad_every=10):
    split = F.when(F.col("id") % 5 < 3, "train").when(F.col("id") % 5 == 3, "valid").otherwise("test")
    return spark.range(1, n + 1).select(
        F.col("id").alias("applicant_id"), (F.col("id") % bad_every == 0).cast("int").alias(TARGET), split.alias("split"), (F.col("id") * 1.5).alias("amount, in 'units'")
    )


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_readers_see_published_versions_only(spark, tmp_path):
    root = f"{tmp_path}/it's gold"
    with pytest.raises(LookupError):
        published.read_published(spark, root)
    good = some_gold(spark, 1000)
    with pytest.raises(published.AuditFailed, match="unique_ids"):
        lake.publish_gold(good.unionByName(good.limit(3)), root, 4)
    with pytest.raises(LookupError):
        lake.published_gold(spark, root)
    first = lake.publish_gold(good, root, 4)
    with pytest.raises(published.AuditFailed, match="null_targets"):
        lake.publish_gold(good.withColumn(TARGET, F.when(F.col("applicant_id") != 7, F.col(TARGET))), root, 4)
    seen = lake.published_gold(spark, root)
    assert sorted(map(tuple, seen.select(good.columns).collect())) == sorted(map(tuple, good.collect()))
    lake.publish_gold(some_gold(spark, 500), root, 4)
    assert lake.published_gold(spark, root).count() == 500 and lake.published_gold(spark, root, first).count() == 1000
    assert published.audits(spark, root).where("NOT passed").count() == 2 and published.publications(spark, root).count() == 2
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("unpublished")]


def test_the_audit_equals_the_expectations(spark, tmp_path):
    for bad_every, rows in ((10, 300), (2, 300), (10, 0)):
        df, root = some_gold(spark, rows, bad_every), f"{tmp_path}/{bad_every}-{rows}"
        try:
            version = lake.publish_gold(df, root, 2)
        except published.AuditFailed as failure:
            version = failure.version
        stored = {r["check"]: (r["value"], r["passed"]) for r in published.audits(spark, root).where(F.col("version") == version).collect()}
        if rows:
            assert stored == {r["check"]: (r["value"], r["passed"]) for r in gold_expectations(df).collect()}
        else:
            assert stored["default_rate"] == (None, None) and stored["splits"] == (0.0, False)


def test_published_tables_join_and_group_by_their_key_without_an_exchange(spark, tmp_path):
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake.publish_gold(some_gold(spark, 1000), f"{tmp_path}/gold", 4)
        gold = lake.published_gold(spark, f"{tmp_path}/gold")
        assert exchanges(gold.groupBy("applicant_id").agg(F.count(F.lit(1)).alias("n"))) == 0
        name = f"decided_{uuid.uuid4().hex}"
        tables.save_named_table(spark.range(1, 1001).withColumnRenamed("id", "applicant_id").withColumn("band", F.lit("A")), name, keys=["applicant_id"], buckets=4, path=f"{tmp_path}/decided")
        joined = gold.join(spark.table(name), "applicant_id")
        assert exchanges(joined) == 0 and joined.count() == 1000
        plain = some_gold(spark, 1000).join(spark.table(name), "applicant_id")
        assert exchanges(plain) > 0
        test = tables.take_split(gold, "test")
        assert "= test)" in test._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_a_batch_that_moved_is_not_committed(spark, tmp_path):
    book = spark.range(2000).select(F.col("id").alias("applicant_id"), (F.col("id") % 100).cast("double").alias("x"), (F.col("id") % 100 > F.col("id") % 70).cast("int").alias(TARGET))
    bins = woe_fit(book, ["x"], TARGET, monotone=False, edges={"x": [10.0, 30.0, 50.0, 70.0]})
    card, dest = Scorecard(bins, {"x": -1.0}, -2.0), f"{tmp_path}/decisions"
    assert monitoring.score_book_gated(book, card, book, dest, "1", "usual")
    with pytest.raises(RuntimeError, match="not published"):
        monitoring.score_book_gated(book.withColumn("x", F.lit(99.0)), card, book, dest, "1", "moved")
    seen = tables.read_appended(spark, dest)
    assert seen.count() == 2000 and [r[0] for r in seen.select("batch").distinct().collect()] == ["usual"]
    assert not monitoring.score_book_gated(book, card, book, dest, "1", "usual")


def test_summary_has_accuracies_and_features(spark):
    rows = [(1, 1, 0, "PAY 1", "income", 10.0), (1, 2, 35, "SHOP 2", "groceries", -4.0), (2, 3, 61, "SHOP 3", "groceries", -2.0)]
    ledger = spark.createDataFrame(rows, "applicant_id long, transaction_id long, day int, description string, true_category string, amount double")
    held = spark.createDataFrame([("groceries", "SHOP")], "true_category string, merchant_stem string")
    accuracies = {"text_only": spark.createDataFrame([(0.25, 8)], "accuracy double, n long")}
    out = lg.track_summary(ledger, held, [], accuracies, ["ob_b", "ob_a"])
    assert {r["metric"]: r["value"] for r in out.collect()} == {
        "applicants": 2, "transactions": 3, "n_categories": 2, "months_of_history": 3, "held_out_merchants": 1, "text_only": 0.25, "feature ob_b": 1, "feature ob_a": 2,
    }
    document = lg.summary_document(out).first()["document"]
    assert '"features":["ob_b","ob_a"]' in document and '"text_only":0.25' in document


# Five example applicants, from the clean file to recent arrears.
INPUTS = (
    "revolving_utilisation", "age", "debt_ratio", "monthly_income", "open_credit_lines", "real_estate_lines", "dependents", "times_30_59_dpd", "times_60_89_dpd", "times_90_dpd",
)
APPLICANTS = [
    (0.03, 66, 0.12, 8000, 12, 2, 0, 0, 0, 0),
    (0.12, 52, 0.24, 5200, 9, 2, 1, 0, 0, 0),
    (0.34, 38, 0.33, 3400, 6, 1, 2, 0, 0, 0),
    (0.30, 44, 0.30, 3300, 6, 0, 2, 1, 0, 0),
    (0.97, 27, 0.71, 1850, 7, 0, 1, 3, 1, 2),
]


def test_example_applicants_are_scored_from_the_form_alone(spark):
    """Grades fall along the five profiles, with a card learnt where use of credit and arrears mean risk."""
    population = spark.range(4000).select(
        (F.col("id") % 100 / 100.0).alias("revolving_utilisation"), (F.floor(F.col("id") / 100) % 4).cast("double").alias("total_delinquencies"),
        ((F.xxhash64("id") % 100 + 100) % 100 < F.col("id") % 100 * 0.3 + F.floor(F.col("id") / 100) % 4 * 15).cast("int").alias("y"),
    )
    bins = woe_fit(population, ["revolving_utilisation", "total_delinquencies"], "y")
    card = Scorecard(bins, {"revolving_utilisation": -0.9, "total_delinquencies": -0.9}, -1.2)
    forms = spark.createDataFrame([(i, *map(float, a)) for i, a in enumerate(APPLICANTS)], "applicant_id long, " + ", ".join(f"{c} double" for c in INPUTS))
    constants = ImputationConstants({"unknown": 5000.0}, 5000.0, 52.0, 0.35)
    rows = decide(derive_features(forms, constants), card).orderBy("applicant_id").collect()
    scores = [r["score"] for r in rows]
    assert len(scores) == 5 and scores == sorted(scores, reverse=True) and scores[0] > scores[-1]
    assert [r["band"] for r in rows] == sorted(r["band"] for r in rows)
