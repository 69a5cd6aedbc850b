"""Helpers used by the registered query builders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import round_doubles


def out(df: DataFrame, digits: int = 6, money: tuple[str, ...] = ()) -> DataFrame:
    """Final projection of a registered query: doubles rounded for cross-engine comparison.

    ``money`` columns are large sums (1e8 and more) whose last digits depend on the
    summation order; they are rounded to cents."""
    df = round_doubles(df, digits)
    if money:
        df = df.select(*[F.round(F.col(c), 2).alias(c) if c in money else F.col(c) for c in df.columns])
    return df
