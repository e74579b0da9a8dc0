"""A spread of the registered queries next to their SQL, on the smallest data."""

import pytest

from catalogue import registry
from tests.compare import compare, duck

SMALL = "/root/testdata/sf0.001"
SPREAD = [
    "a02_bronze_land", "b08_dq_report", "b09_silver", "c10_constants", "c11_gold", "c13_parity", "d07_woe_iv_coarse", "d17_corr_pairs",
    "e10_decision_fixed_model", "f03_evaluate", "f04_calibration", "f05_gains", "f06_approval", "f08_business", "f11_segments", "f13_hist",
    "g04_reason_codes", "h04_drift", "h09_gate", "i03_i05_behaviour", "i06_holdout", "i07_char_ngrams", "i13_i18_cashflow",
]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", SPREAD)
def test_same_rows_as_sql(spark, con, name):
    message, _, ok = compare(spark, con, name, SMALL, registry.queries(), registry.oracles())
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(registry.oracles()) <= set(registry.queries())
