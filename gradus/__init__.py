"""gradus: credit-risk scorecards as Spark DataFrame operators.

Every operator takes and returns DataFrames.  The driver only ever holds tables whose size
is set by the model (features x bins, coefficients, cut points), never by the data.
"""

__version__ = "0.1.0"
