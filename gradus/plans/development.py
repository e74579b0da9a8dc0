"""Scorecard development: bins, selection, champion and challenger, reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradus.functions.columns import DEFAULT_BANDS
from gradus.operators import evaluation as ev
from gradus.operators.drift import psi, with_verdict
from gradus.operators.features import MODEL_FEATURES, TARGET
from gradus.operators.fitting import Challenger, fit_calibrator, fit_challenger, fit_champion
from gradus.operators.scoring import Scorecard, add_log_odds, score, sigmoid
from gradus.operators.selection import Selection, fit_and_select
from gradus.operators.woe import WoeBins
from gradus.sources.tables import materialise, take_split, write_report

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Development:
    bins: WoeBins
    selection: Selection
    card: Scorecard
    challenger: Challenger | None

    @property
    def scorers(self) -> dict[str, Scorer]:
        out: dict[str, Scorer] = {"logistic_woe": lambda d: score(d, self.card)}
        if self.challenger is not None:
            out["boosted"] = self.challenger.score
        return out


def develop(
    gold: DataFrame, features: list[str] | None = None, target: str = TARGET, calibration: str = "isotonic", rounds: int | None = 400,
    bands=DEFAULT_BANDS,
) -> Development:
    """Fit on train, calibrate on valid.  ``rounds=None`` leaves the challenger out."""
    features = [f for f in (features or MODEL_FEATURES) if f in gold.columns]
    train, valid = take_split(gold, "train"), take_split(gold, "valid")
    bins, selection = fit_and_select(materialise(train.select(target, *features)), features, target)
    card = fit_champion(train, bins.only(selection.selected), target, bands=bands)
    raw = add_log_odds(valid, card, "_l").select(sigmoid(F.col("_l")).alias("p"), target)
    card = card.with_calibrator(fit_calibrator(raw, "p", target, calibration))
    challenger = None
    if rounds:
        challenger = fit_challenger(train, valid, selection.selected, target, max_iter=rounds)
        curve = fit_calibrator(challenger.raw_probability(valid), "_raw", target, calibration)
        challenger = replace(challenger, calibrator=curve, bands=bands)
    return Development(bins, selection, card, challenger)


def candidate_metrics(scorers: dict[str, Scorer], gold: DataFrame, target: str = TARGET) -> DataFrame:
    """The eight metrics of every model on every split, in one grouped evaluation."""
    parts = [
        f(gold).select(F.lit(name).alias("model"), "split", target, "probability_of_default") for name, f in scorers.items()
    ]
    return ev.evaluate(reduce(DataFrame.unionByName, parts), "probability_of_default", target, by=["model", "split"])


def pick_champion(scorers: dict[str, Scorer], configured: str = "logistic_woe") -> str:
    return configured if configured in scorers else next(iter(scorers))


def champion_reports(gold: DataFrame, scorer: Scorer, target: str = TARGET, bands=DEFAULT_BANDS, id_col: str = "applicant_id") -> dict[str, DataFrame]:
    """Diagnostics of the champion.  The book is scored once and the scored rows are staged."""
    scored = materialise(scorer(gold).select(
        id_col, "split", "age_band", F.col(target).alias("y"), F.col("probability_of_default").alias("p"), "raw_score", "score", "band"
    ))
    train, valid, test = (take_split(scored, s) for s in ("train", "valid", "test"))
    valid_curve = ev.approval_curve(valid, "p", "y", id_col)
    band_rows = materialise(ev.band_table(test, "y", bands))
    return {
        "calibration": ev.calibration_table(test, "p", "y", id_col),
        "gains": ev.gains_table(test, "p", "y", id_col),
        "approval_curve": ev.approval_curve(test, "p", "y", id_col),
        "approval_curve_validation": valid_curve,
        # Chosen on validation, applied unchanged to test.
        "business": ev.apply_cutoff(test, "p", "y", ev.best_cutoff(valid_curve), "raw_score"),
        "bands": band_rows,
        "bands_monotonic": ev.bands_monotonic(band_rows),
        "stability": with_verdict(psi(train, test, ["p"])),
        "segments": ev.segment_report(test, "p", "y", "age_band"),
    }


def write_development(result: Development, gold: DataFrame, folder: str) -> None:
    spark = gold.sparkSession
    result.card.save(spark, f"{folder}/scorecard")
    if result.challenger is not None:
        result.challenger.save(spark, f"{folder}/challenger")
    write_report(result.selection.report(spark), f"{folder}/information_values")
    write_report(result.bins.table(spark), f"{folder}/woe_bin_table")
    write_report(candidate_metrics(result.scorers, gold), f"{folder}/metrics")
    name = pick_champion(result.scorers)
    for report, df in champion_reports(gold, result.scorers[name], bands=result.card.bands).items():
        write_report(df, f"{folder}/{report}")
