"""Isotonic regression over weighted distinct scores (M5).

1. Rows collapse to distinct scores with weight and weighted label (map-side combined: a hot score is one row).
2. The scores are cut into ranges; each task pools adjacent violators of its range into a list of blocks with rising means.
3. Neighbouring lists are merged, FAN ranges at a time, until one level is left for the driver. Pooling is associative:
   the pooled list of two ranges is the pooled concatenation of their lists, so the blocks are those of one
   sequential run, and only blocks travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import reliable_checkpoint

#: Range lists merged in one task.
FAN = 16
BLOCKS = "lo double, hi double, w double, s double"
COLUMNS = ["lo", "hi", "w", "s"]


def pool(blocks) -> list[tuple[float, float, float, float]]:
    """Pooled list of (lo, hi, weight, weighted label) blocks in score order: means rise strictly."""
    stack: list[tuple[float, float, float, float]] = []
    for lo, hi, w, s in blocks:
        while stack and stack[-1][3] * w >= s * stack[-1][2]:
            top = stack.pop()
            lo, w, s = top[0], top[2] + w, top[3] + s
        stack.append((lo, hi, w, s))
    return stack


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in COLUMNS)))
    found = pool(rows)
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.float64()) for k in range(4)], names=COLUMNS)


def fit_blocks(df: DataFrame, score: str, label: str, weight: str | None = None, ranges: int | None = None) -> list[tuple]:
    """Blocks (lo, hi, weight, mean label) of the rising step function closest to the labels; rows without
    score, label or weight do not count."""
    spark = df.sparkSession
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select((F.col(score).cast("double") + F.lit(0.0)).alias("lo"), F.col(label).cast("double").alias("y"), w.alias("w")).filter(
        "lo is not null and not isnan(lo) and y is not null and w > 0")
    distinct = rows.groupBy("lo").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("s")).select(
        "lo", F.col("lo").alias("hi"), "w", "s")
    parts = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = distinct.repartitionByRange(parts, "lo").sortWithinPartitions("lo").mapInArrow(_pooled, BLOCKS)
    while parts > FAN:
        parts = -(-parts // FAN)
        lists = reliable_checkpoint(lists).repartitionByRange(parts, "lo").sortWithinPartitions("lo").mapInArrow(_pooled, BLOCKS)
    found = pool(sorted(tuple(r) for r in lists.collect()))
    return [(lo, hi, w_, s / w_) for lo, hi, w_, s in found]


def fit(df: DataFrame, score: str, label: str, weight: str | None = None, prediction: str = "__cal",
        ranges: int | None = None) -> IsotonicRegressionModel:
    """MLlib's model of the blocks: constant on a block, linear between blocks, constant beyond the ends."""
    spark = df.sparkSession
    rows = [r for lo, hi, w, mean in fit_blocks(df, score, label, weight, ranges)
            for r in ([(lo, mean, w)] if lo == hi else [(lo, mean, w / 2), (hi, mean, w / 2)])]
    if not rows:
        raise ValueError("no row with a score and a label")
    small = spark.createDataFrame(rows, "x double, y double, w double")
    return IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w", predictionCol=prediction, isotonic=True).fit(
        small).setFeaturesCol(score)
