"""Literals shared by the fixed-model queries and their SQL."""

from gradus.operators.scoring import IsotonicCurve

FIXED_EDGES = {
    "revolving_utilisation": [0.02, 0.04, 0.05, 0.06],
    "age": [30.0, 45.0, 60.0],
    "times_30_59_dpd": [0.0, 1.0],
    "times_90_dpd": [0.0],
    "debt_ratio": [1.0, 2.0, 3.0],
    "monthly_income": [2000.0, 5000.0, 8000.0],
}
BETAS = {
    "revolving_utilisation": -0.9,
    "age": -0.6,
    "times_30_59_dpd": -0.85,
    "times_90_dpd": -0.75,
    "debt_ratio": -0.5,
    "monthly_income": -0.4,
}
INTERCEPT = -1.6
CURVE = IsotonicCurve([0.05, 0.1, 0.15, 0.2, 0.3], [0.03, 0.09, 0.16, 0.22, 0.35])
# Bands of the test book: its scores run lower than those of a real one.
BANDS = (("A", 555.0, "Very low risk"), ("B", 545.0, "Low risk"), ("C", 535.0, "Moderate risk"), ("D", 525.0, "Elevated risk"), ("E", 0.0, "High risk"))
EXPECTED_ROWS = 150_000
SEED = 42
