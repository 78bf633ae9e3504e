"""Averages that two engines agree on.

Each engine adds doubles in its own order, so averages differ in the last bits; rounding hides that
unless the value lies on a rounding boundary, as averages of short decimals often do. A shift far
below the kept digits moves them off it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS, SHIFT = 6, 1.23e-9


def stable(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + SHIFT, DIGITS) for c in columns})


def stable_sql(expression: str) -> str:
    return f"round({expression} + {SHIFT}, {DIGITS})"


AVG_METRIC = stable_sql("avg(metric_value)")
