"""riskframe: credit-risk analytics expressed as Spark DataFrame plans.

Every public operator takes DataFrames and returns a lazy DataFrame; driver-side
state is bounded by the number of features, bins or thresholds, never by rows.
"""

__version__ = "0.1.0"
