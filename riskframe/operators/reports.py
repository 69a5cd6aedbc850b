"""Report tables (G1-G3): every number of the metrics report and model card as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Retraining triggers.
RETRAIN_PSI = 0.25
RETRAIN_AUC_DROP = 0.05


def long_metrics(df: DataFrame, section: str, id_cols: Sequence[str] = (), model: str | None = None) -> DataFrame:
    """Unpivot the numeric columns of a metrics frame into (section, model, metric, value)."""
    ids = list(id_cols)
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ids]
    sel = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in nums])
    long = sel.unpivot(ids, nums, "metric", "value")
    mdl = F.col(ids[0]).cast("string") if ids and model is None else F.lit(model)
    return long.select(F.lit(section).alias("section"), mdl.alias("model"), "metric", "value")


def metrics_report(sections: dict[str, DataFrame], model: str | None = None) -> DataFrame:
    """G1: union of long metric tables, one per report section."""
    parts = [long_metrics(df, name, model=model) for name, df in sections.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def retrain_trigger(auc_reference: DataFrame, auc_current: DataFrame, psi: DataFrame,
                    psi_limit: float = RETRAIN_PSI, auc_drop_limit: float = RETRAIN_AUC_DROP) -> DataFrame:
    """Retrain when PSI > limit or the AUC dropped by more than the limit.
    Inputs are one-row frames with columns ``auc`` / ``auc`` / ``psi``."""
    a = auc_reference.select(F.col("auc").alias("auc_reference"), F.lit(1).alias("_k"))
    b = auc_current.select(F.col("auc").alias("auc_current"), F.lit(1).alias("_k"))
    c = psi.select(F.col("psi"), F.lit(1).alias("_k"))
    j = a.join(b, on="_k").join(c, on="_k").drop("_k")
    drop = F.col("auc_reference") - F.col("auc_current")
    return j.select("auc_reference", "auc_current", drop.alias("auc_drop"), "psi",
                    (F.col("psi") > psi_limit).alias("psi_trigger"), (drop > auc_drop_limit).alias("auc_trigger"),
                    ((F.col("psi") > psi_limit) | (drop > auc_drop_limit)).alias("retrain"))


def model_card_tables(iv_table: DataFrame, reliability: DataFrame, report: DataFrame,
                      thresholds: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables that fill the model card (rendering is left to the caller)."""
    t = {"features": iv_table, "calibration": reliability, "metrics": report}
    if thresholds is not None:
        t["thresholds"] = thresholds
    return t
