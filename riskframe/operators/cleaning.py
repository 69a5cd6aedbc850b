"""Rule-based cleaning (P1-P6, P11): one projection + one filter, no per-rule pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass(frozen=True)
class CleanRules:
    drop_columns: Sequence[str] = ()                      # P1 identifiers
    sentinels: Mapping[str, Sequence[object]] = field(default_factory=dict)  # P2 value -> missing
    invalid_values: Mapping[str, Sequence[object]] = field(default_factory=dict)  # P3 rows dropped
    target: str | None = None                             # P4 cast to int
    nan_to_null: bool = True                              # NaN and NULL become one notion of missing


# The application-table rule set (identifier, sentinel codes, invalid category).
APPLICATION_RULES = CleanRules(
    drop_columns=("SK_ID_CURR",),
    sentinels={
        "DAYS_EMPLOYED": (365243,),
        "DAYS_LAST_PHONE_CHANGE": (0,),
        "REGION_RATING_CLIENT": (-1,),
        "REGION_RATING_CLIENT_W_CITY": (-1,),
    },
    invalid_values={"CODE_GENDER": ("XNA",)},
    target="TARGET",
)


def clean(df: DataFrame, rules: CleanRules = APPLICATION_RULES) -> DataFrame:
    """P5: apply the rules that match existing columns (absent columns are skipped).

    Invalid-category rows are dropped null-safely: a missing value is kept
    (plain ``!=`` would drop it)."""
    cols = set(df.columns)
    keep_row = F.lit(True)
    for c, bad in rules.invalid_values.items():
        if c in cols:
            for v in bad:
                keep_row = keep_row & ~F.col(c).eqNullSafe(F.lit(v))
    out = df.where(keep_row)
    proj = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in df.columns:
        if c in rules.drop_columns:
            continue
        e = F.col(c)
        if rules.nan_to_null and isinstance(types[c], (DoubleType, FloatType)):
            e = F.when(~F.isnan(e), e)
        for v in rules.sentinels.get(c, ()):
            e = F.when(~e.eqNullSafe(F.lit(v)), e)
        if c == rules.target:
            e = e.cast("int")
        proj.append(e.alias(c))
    return out.select(*proj)


def null_if(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """P2 as a standalone helper: replace a sentinel value by NULL in existing columns."""
    return df.select(*[F.nullif(F.col(c), F.lit(sentinels[c])).alias(c) if c in sentinels else F.col(c)
                       for c in df.columns])


def feature_columns(df: DataFrame, target: str, date_column: str | None = None,
                    forbidden: Sequence[str] = ()) -> list[str]:
    """All columns minus target, date and forbidden columns (metadata only)."""
    skip = {target, date_column, *forbidden}
    return [c for c in df.columns if c not in skip]


def profile(df: DataFrame, target: str, top: int = 20) -> tuple[DataFrame, DataFrame]:
    """Target counts and the ``top`` columns by missing count (one aggregate for all columns)."""
    counts = df.groupBy(target).count()
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = nulls.unpivot([], df.columns, "column_name", "n_missing")
    return counts, long.orderBy(F.col("n_missing").desc(), F.col("column_name")).limit(top)
