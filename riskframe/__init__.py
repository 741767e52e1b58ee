"""riskframe: tabular risk analytics expressed as lazy Spark DataFrame plans.

Sub-packages
------------
sources    table readers (parquet fixtures, CSV, tracking store) and sinks
functions  column-expression helpers (hashing, scalar exprs, distributed ranking)
operators  DataFrame -> DataFrame operators: profiling, splits, encoders,
           resampling, leakage, scoring, metrics, tuning analysis, leaderboards
plans      MLlib model builders, the named query catalog and its SQL oracle
"""

__version__ = "0.1.0"
