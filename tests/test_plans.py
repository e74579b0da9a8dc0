"""End to end: CSV -> lake -> model -> decisions -> monitoring, in batch and by increments."""

import csv

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradus.operators import evaluation as ev
from gradus.operators.features import ImputationConstants, derive_features
from gradus.operators.scoring import Scorecard, decide
from gradus.plans import development, lake, monitoring
from gradus.sources import tables
from gradus.streaming import increments


@pytest.fixture(scope="module")
def raw_csv(tmp_path_factory):
    rng = np.random.default_rng(1)
    path = tmp_path_factory.mktemp("raw") / "extract.csv"
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["", *tables.RAW_COLUMN_NAMES])
        for i in range(1, 3001):
            util, late = float(rng.uniform()), int(rng.poisson(0.4))
            bad = int(rng.uniform() < 1 / (1 + np.exp(4 - 3 * util - 1.2 * late)))
            income = "NA" if i % 6 == 0 else int(rng.lognormal(8.4, 0.5))
            w.writerow([i, bad, round(util, 4), int(rng.integers(18, 90)), late, round(float(rng.uniform()), 3), income, int(rng.integers(1, 12)),
                        int(rng.poisson(0.1)), int(rng.integers(0, 3)), int(rng.poisson(0.2)), "NA" if i % 50 == 0 else int(rng.integers(0, 4))])
    return str(path)


@pytest.fixture(scope="module")
def built(spark, raw_csv, tmp_path_factory):
    return lake.build_lake(spark, raw_csv, str(tmp_path_factory.mktemp("lake")))


@pytest.fixture(scope="module")
def gold(spark, built):
    return tables.read_gold(spark, built.gold)


@pytest.fixture(scope="module")
def result(gold):
    return development.develop(gold, ["revolving_utilisation", "times_30_59_dpd", "total_delinquencies", "age", "monthly_income"], rounds=3)


def test_lake_layers(spark, built, gold):
    bronze = tables.read_table(spark, built.bronze)
    assert all(t == "string" for c, t in bronze.dtypes if c != "ingested_at") and bronze.first()["source_file"] == "extract.csv"
    assert tables.landed_check(bronze, ["applicant_id"], 3000).where("passed").count() == 2
    assert gold.count() == 3000 and {r[0] for r in gold.select("split").distinct().collect()} == {"train", "valid", "test"}
    plan = tables.take_split(gold, "test")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ValueError):
        tables.read_gold(spark, built.silver)


def test_replay_from_stored_constants(spark, built, gold):
    stored = spark.read.csv(built.report("imputation_constants"), header=True, schema="constant string, age_band string, value double")
    silver = tables.read_table(spark, built.silver)
    again = derive_features(silver, ImputationConstants.from_frame(stored))
    assert again.join(gold, "applicant_id").where(~again["monthly_income"].eqNullSafe(gold["monthly_income"])).count() == 0


def test_development_and_reports(spark, gold, result, tmp_path):
    metrics = {(r["model"], r["split"]): r for r in development.candidate_metrics(result.scorers, gold).collect()}
    assert len(metrics) == 6 and metrics["logistic_woe", "test"]["gini"] > 0.3
    assert development.pick_champion(result.scorers) == "logistic_woe" and development.pick_champion({"boosted": None}) == "boosted"
    reports = development.champion_reports(gold, result.scorers["logistic_woe"])
    business = reports["business"].first()
    assert business["profit_uplift"] == pytest.approx(business["expected_profit_at_cutoff"] - business["expected_profit_approve_all"])
    assert reports["stability"].first()["verdict"] == "stable"
    assert sum(r["population_share"] for r in reports["bands"].collect()) == pytest.approx(1.0)
    development.write_development(result, gold, str(tmp_path / "reports"))
    assert Scorecard.load(spark, str(tmp_path / "reports/scorecard")).features == result.card.features
    assert spark.read.csv(str(tmp_path / "reports/gains"), header=True).count() == 10


def test_band_rates_fall_with_the_grade(gold, result):
    bands = (("A", 590.0, "a"), ("B", 560.0, "b"), ("C", 0.0, "c"))
    scored = result.scorers["logistic_woe"](gold)
    by = scored.groupBy(F.when(F.col("raw_score") >= 590, 2).when(F.col("raw_score") >= 560, 1).otherwise(0).alias("g")).agg(F.avg("target_default_90dpd_2yr").alias("r"))
    rates = [r["r"] for r in by.orderBy("g").collect()]
    assert rates == sorted(rates, reverse=True) and len(bands) == 3
    assert ev.ks(scored, "probability_of_default", "target_default_90dpd_2yr").first()["ks"] > 0.2


def test_scheduled_scoring_and_monitoring(spark, gold, result, tmp_path):
    decisions, log = str(tmp_path / "decisions"), str(tmp_path / "monitoring")
    for version in ("1", "2"):
        monitoring.score_book(gold, result.card, decisions, version)
    assert spark.read.parquet(decisions).count() == 6000
    train, test = tables.take_split(gold, "train"), tables.take_split(gold, "test")
    monitoring.monitor(train, test, result.card, log, "2")
    far = test.withColumns({"revolving_utilisation": F.lit(2.0), "times_30_59_dpd": F.lit(9.0), "total_delinquencies": F.lit(9.0)})
    with pytest.raises(RuntimeError):
        monitoring.monitor(train, far, result.card, log, "2")
    rows = spark.read.parquet(log).collect()
    assert sorted(r["score_verdict"] for r in rows) == ["revalidate", "stable"] and all("psi" in r["largest_shifts"] for r in rows)
    both = monitoring.control_and_treatment(gold, result.card).collect()
    assert both[0]["score_psi"] < both[1]["score_psi"]


def test_increments_score_each_file_once(spark, gold, result, tmp_path):
    landing, dest, mark = (str(tmp_path / n) for n in ("landing", "out", "mark"))
    narrow = gold.drop("split")
    for part in range(2):
        narrow.where(F.col("applicant_id") % 2 == part).coalesce(1).write.mode("append").parquet(landing)
        stream = increments.read_increments(spark, landing, narrow.schema)
        increments.append_increments(increments.score_applicants(stream, result.card), dest, mark, "1").awaitTermination(120)
    got = spark.read.parquet(dest).drop("scored_at", "model_version")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, decide(narrow, result.card).collect()))


def test_named_tables(spark, gold):
    tables.save_named_table(gold.limit(5), "gradus_gold_sample")
    assert spark.table("gradus_gold_sample").count() == 5
    spark.sql("DROP TABLE gradus_gold_sample")
