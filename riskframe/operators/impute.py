"""Median/mode imputation (P9): one aggregate to fit, ``na.fill``-style projection to apply."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from riskframe.functions.exprs import is_missing, melt
from riskframe.operators.binning import clean_double, exact_quantiles

# Fixed value: fill for a categorical column that is missing everywhere.
ALL_MISSING_CATEGORY = "Unknown"


@dataclass(frozen=True)
class ImputerState:
    numeric: dict[str, float | None]
    categorical: dict[str, str]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, "numeric", v, None) for c, v in self.numeric.items()]
        rows += [(c, "categorical", None, v) for c, v in self.categorical.items()]
        return spark.createDataFrame(rows, "column_name string, kind string, num_value double, cat_value string")


def _is_numeric(dt) -> bool:
    return isinstance(dt, (NumericType, BooleanType))


def fit_imputer(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False,
                accuracy: int = 100000) -> ImputerState:
    """Fit on columns that have a missing value: numeric -> median (mean of the middle two;
    ``approx`` switches to ``percentile_approx``), other -> most frequent value, smallest on
    ties, ``Unknown`` if all missing. Medians and modes are distributed aggregations over
    value counts; only one value per column reaches the driver."""
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    has_null = df.agg(*[F.max(is_missing(df, c).cast("int")).alias(c) for c in cols]).first()
    todo = [c for c in cols if has_null[c] == 1]
    if not todo:
        return ImputerState({}, {})
    num_cols = [c for c in todo if _is_numeric(types[c])]
    cat_cols = [c for c in todo if not _is_numeric(types[c])]
    num: dict[str, float | None] = {}
    if num_cols:
        if approx:
            row = df.agg(*[F.percentile_approx(clean_double(c), 0.5, accuracy).alias(c) for c in num_cols]).first()
            num = {c: None if row[c] is None else float(row[c]) for c in num_cols}
        else:
            med = exact_quantiles(df, {c: clean_double(c) for c in num_cols}, [0.5])
            num = {c: (None if med[c][0] is None else float(med[c][0])) for c in num_cols}
    cat: dict[str, str] = {c: ALL_MISSING_CATEGORY for c in cat_cols}
    if cat_cols:
        # Mode without a per-column value map in one task: counts per value (map-side combined),
        # the max count per column, then the smallest value holding it.
        vc = (melt(df, [], {c: F.col(c).cast("string") for c in cat_cols}, name_col="column_name", value_col="value")
              .where(F.col("value").isNotNull())
              .groupBy("column_name", "value").count())
        mx = vc.groupBy("column_name").agg(F.max("count").alias("m"))
        best = (vc.join(F.broadcast(mx), on="column_name").where(F.col("count") == F.col("m"))
                .groupBy("column_name").agg(F.min("value").alias("mode")))
        for r in best.collect():  # one row per column
            cat[r["column_name"]] = r["mode"]
    return ImputerState(num, cat)


def impute(df: DataFrame, state: ImputerState) -> DataFrame:
    """Apply a fitted state; columns not in the frame are ignored, columns without a value
    at fit time are not filled. Integer columns become double (filling 2.5 into an int
    column would truncate)."""
    proj = []
    for c in df.columns:
        if c in state.numeric and state.numeric[c] is not None:
            proj.append(F.coalesce(clean_double(c), F.lit(state.numeric[c])).alias(c))
        elif c in state.categorical:
            proj.append(F.coalesce(F.col(c).cast("string"), F.lit(state.categorical[c])).alias(c))
        else:
            proj.append(F.col(c))
    return df.select(*proj)
