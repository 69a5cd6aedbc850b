"""Bucketing expressions.

Two edge conventions exist and must not be mixed:

* right-closed with the lowest edge included (WOE bins): bin i is (e_i, e_{i+1}],
  bin 0 also holds e_0; values outside [e_0, e_k] or missing get no bin (null);
* left-closed with open ends (PSI buckets, reliability bins, threshold buckets):
  index = number of cut points <= x, so outliers fall into the end buckets.

Both compile to CASE chains inside whole-stage codegen. For long cut lists
``bucketize_frame`` uses MLlib's ``Bucketizer`` (binary search, JVM side).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linspace(start: float, stop: float, num: int) -> list[float]:
    """numpy's linspace values (not k/100 arithmetic: 14 of 50 thresholds differ)."""
    return [float(v) for v in np.linspace(start, stop, num)]


def sql_float(v: float) -> str:
    """Round-trippable double literal for SQL text."""
    if v == float("inf"):
        return "'Infinity'::DOUBLE"
    if v == float("-inf"):
        return "'-Infinity'::DOUBLE"
    return f"CAST({repr(float(v))} AS DOUBLE)"


def left_closed_index(col: Column | str, cuts: Sequence[float]) -> Column:
    """Number of cut points <= x (0..len(cuts)); null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    cuts = list(cuts)
    if not cuts:
        return F.when(c.isNotNull(), F.lit(0))
    expr = None
    for i, cut in enumerate(cuts):
        cond = c < F.lit(float(cut))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(expr.otherwise(F.lit(len(cuts))))


def right_closed_bin(col: Column | str, edges: Sequence[float]) -> Column:
    """Bin id in 0..len(edges)-2 for (e_i, e_{i+1}], lowest edge included; else null."""
    c = F.col(col) if isinstance(col, str) else col
    edges = list(edges)
    if len(edges) < 2:
        return F.lit(None).cast("int")
    expr = F.when(c.isNull() | (c < F.lit(float(edges[0]))) | (c > F.lit(float(edges[-1]))), F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:]):
        expr = expr.when(c <= F.lit(float(e)), F.lit(i))
    return expr


def bucketize_frame(df: DataFrame, col: str, cuts: Sequence[float], out: str) -> DataFrame:
    """Left-closed bucketing for long cut lists: binary search per row via ``Bucketizer``.

    Output is an int index equal to ``left_closed_index(col, cuts)``.
    """
    cuts = sorted(set(float(c) for c in cuts))
    if not cuts:  # Bucketizer needs an interior split; one bucket for everything
        return df.withColumn(out, F.when(F.col(col).isNotNull(), F.lit(0)))
    splits = [float("-inf"), *cuts, float("inf")]
    tmp = f"__{out}_bucket"
    b = Bucketizer(splits=splits, inputCol=col, outputCol=tmp, handleInvalid="keep")
    return b.transform(df).withColumn(out, F.col(tmp).cast("int")).drop(tmp)
