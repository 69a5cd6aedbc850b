"""Batch scoring (M9/M10, the scoring core of the reference's demo app).

One lazy plan: WOE projection -> assembler -> fold models -> isotonic maps ->
band -> decision, over any number of rows and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.decisions import HIGH_PD, LOW_PD, assign_decision, assign_risk_band
from riskframe.operators.models import CalibratedModel
from riskframe.operators.woe import WoeModel

TOP_DRIVERS = 10


def score_batch(df: DataFrame, encoder: WoeModel, model: CalibratedModel, low: float = LOW_PD, high: float = HIGH_PD,
                keep: Sequence[str] = ()) -> DataFrame:
    """Encode with WOE, score, band and decide. Output: keep..., model features (WOE), pd, risk_band, decision."""
    enc = encoder.transform(df.select(*keep, *[c for c in encoder.features if c in df.columns]))
    scored = model.score(enc, out="pd")
    return assign_decision(assign_risk_band(scored, "pd", low, high), "pd", low, high)


def top_drivers(df: DataFrame, woe_features: Sequence[str], keep: Sequence[str], k: int = TOP_DRIVERS) -> DataFrame:
    """Per row, the ``k`` features with the largest |WOE|, as rows (keep..., rank, feature, woe).
    Sorting an array of structs per row: no shuffle."""
    arr = F.array(*[F.struct(F.abs(F.col(c)).alias("a"), F.lit(c).alias("feature"), F.col(c).alias("woe"))
                    for c in woe_features])
    top = F.slice(F.sort_array(arr, asc=False), 1, k)
    return (df.select(*keep, F.posexplode(top).alias("pos", "d"))
            .select(*keep, (F.col("pos") + 1).alias("rank"), F.col("d.feature").alias("feature"), F.col("d.woe").alias("woe")))


def scorecard(df: DataFrame, coefficients: dict[str, float], intercept: float, out: str = "pd") -> DataFrame:
    """Fixed-coefficient logistic scorecard on WOE columns: pd = 1 / (1 + exp(-(b0 + sum b_j * woe_j)))."""
    z = F.lit(float(intercept))
    for c, b in coefficients.items():
        z = z + F.lit(float(b)) * F.col(c)
    return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
