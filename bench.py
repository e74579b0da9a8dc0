"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

HEADLINE = (
    "a07_gold_by_split", "b08_dq_report", "b09_silver", "c10_constants", "c11_gold", "c13_parity", "d03_bin_counts", "d06_monotone_bins",
    "d12_iv_rank", "d17_corr_pairs", "d18_selection", "e01_logistic", "e03_isotonic", "e07_score_scaling", "e10_decision_fixed_model",
    "f03_evaluate", "f04_calibration", "f05_gains", "f06_approval", "f08_business", "f11_segments", "f13_hist", "g03_contributions",
    "g04_reason_codes", "g07_reconstruct", "h01_psi", "h04_drift", "h08_expectations", "i03_i05_behaviour", "i06_holdout", "i07_char_ngrams",
    "i13_i18_cashflow", "i20_invariants", "g08_permutation_importance", "h06_control_and_treatment", "i08_text_clf", "i12_categorise",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tests.session import make_session

    spark = make_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    from catalogue import registry

    queries = registry.queries()
    queries["f01_auc"](spark, sf_dir).collect()  # starts the executors and the code cache
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
