"""Scheduled scoring and monitoring of a book."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.operators.drift import DriftReport, drift_report, psi, stability_bins, stop_the_line, stress_shift, with_verdict
from gradus.operators.scoring import Scorecard, decide, score
from gradus.sources.tables import append_decisions, append_monitoring_row, materialise, take_split


def score_book(gold: DataFrame, card: Scorecard, dest: str, model_version: str, batch: str | None = None) -> bool:
    """Append a decision per applicant.  Scoring is plain expressions: no UDF, no shuffle.

    A named batch is added once, however often the job is run.
    """
    return append_decisions(decide(gold, card), dest, model_version, batch=batch)


def score_book_gated(gold: DataFrame, card: Scorecard, reference: DataFrame, dest: str, model_version: str, batch: str | None = None, **limits) -> bool:
    """``score_book``, but a batch whose scores have moved too far from the reference's is written and not committed.

    Raises then; readers of the decisions never see the batch.  The audit reads back the written scores, one column.
    """
    def audit(written: DataFrame) -> None:
        row = with_verdict(psi(decide(reference, card).select("score"), written.select("score"), ["score"]), **limits).first()
        if row is None or row["verdict"] == "revalidate":
            raise RuntimeError(f"decisions are not published: score PSI {row['psi']:.4f}" if row else "decisions are not published: too few rows to compare")

    return append_decisions(decide(gold, card), dest, model_version, batch=batch, audit=audit)


def monitor(
    reference: DataFrame, current: DataFrame, card: Scorecard, dest: str, model_version: str, fail: bool = True, **limits
) -> DriftReport:
    """Append one monitoring row; stop when the population must be revalidated.

    Both sides are given by the caller, so the reference need not be part of the current one.
    """
    report = drift_report(score(reference, card), score(current, card), card.features, "raw_score", **limits)
    append_monitoring_row(report.record(), dest, model_version)
    if fail:
        stop_the_line(report)
    return report


def control_and_treatment(gold: DataFrame, card: Scorecard, seed: int = 42, intensity: float = 1.0) -> DataFrame:
    """Drift of the holdout (should be none) and of a stressed holdout (should be seen).

    One row per population: the score's summary and the largest feature shifts.  The bins of the
    reference are worked out once for both.
    """
    train, test = take_split(gold, "train"), take_split(gold, "test")
    narrow = ["applicant_id", *card.features, "raw_score"]
    reference = materialise(score(train, card).select(*narrow))
    spec = stability_bins(reference, ["raw_score", *card.features], 10)
    rows = []
    for population, side in (("holdout", test), ("shifted_population", stress_shift(test, "applicant_id", seed, intensity))):
        report = drift_report(reference, score(side, card).select(*narrow), card.features, "raw_score", spec=spec)
        rows.append(report.record().withColumn("population", F.lit(population)))
    return rows[0].unionByName(rows[1])
