"""Readers for the driver tables and the derived ``loans`` fixture.

``loans`` turns ``lineitem`` into a credit-risk style table with exact integer
arithmetic, so the same text runs in Spark and in the DuckDB oracle:
a score ``p`` in (0, 1), a binary target ``y`` that depends on ``p`` and a row
hash, a time-based ``split`` and an exposure ``l_extendedprice``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture (shared with the SQL oracle text).
LOAN_SCORE_SQL = (
    "cast(l_quantity as int)*100 + cast(round(l_discount*100) as int)*200 "
    "+ cast(round(l_tax*100) as int)*100"
)
LOAN_HASH_SQL = "(l_orderkey*7919 + l_partkey*104729 + l_suppkey*1299709 + l_linenumber*15485863) % 10000"
SPLIT_TRAIN_END = "1999-01-01"
SPLIT_TEST_END = "2000-07-01"

LOAN_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LOAN_NUMERIC = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
LOAN_CATEGORICAL = ["l_linestatus", "l_returnflag"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``loans`` view: lineitem + score ``p`` + target ``y`` + ``split``."""
    li = read_table(spark, sf_dir, "lineitem")
    s_int = F.expr(LOAN_SCORE_SQL)
    return (
        li.select(*LOAN_KEY, *LOAN_NUMERIC, *LOAN_CATEGORICAL, "l_shipdate")
        .withColumn("s_int", s_int)
        .withColumn("p", F.col("s_int").cast("double") / F.lit(10000.0))
        .withColumn("y", F.expr(f"case when {LOAN_HASH_SQL} < s_int then 1 else 0 end"))
        .withColumn(
            "split",
            F.when(F.col("l_shipdate") < F.lit(SPLIT_TRAIN_END).cast("timestamp_ntz"), "train")
            .when(F.col("l_shipdate") < F.lit(SPLIT_TEST_END).cast("timestamp_ntz"), "test")
            .otherwise("oot"),
        )
    )


def split_filter(part: str) -> Column:
    """Rows of one ``split`` of the loans view as a direct ``l_shipdate`` range (pushed to the
    Parquet scan). Same partition as the ``split`` label: a missing date is 'oot' there."""
    d = F.col("l_shipdate")
    lo, hi = F.lit(SPLIT_TRAIN_END).cast("timestamp_ntz"), F.lit(SPLIT_TEST_END).cast("timestamp_ntz")
    return {"train": d < lo, "test": (d >= lo) & (d < hi), "oot": (d >= hi) | d.isNull()}[part]


def events_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


# Fixed values of the fixture's missing-value variant: sentinels turned into NULL.
GAP_SENTINELS = {"l_discount": 0.0, "l_tax": 0.0, "l_returnflag": "R"}
GAP_COLUMNS = [*LOAN_KEY, "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_linestatus", "l_returnflag",
               "l_shipdate", "p", "y", "split"]


def loans_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``loans`` with missing values: zero discount/tax and return flag 'R' become NULL."""
    base = loans(spark, sf_dir)
    return base.select(*[F.nullif(F.col(c), F.lit(GAP_SENTINELS[c])).alias(c) if c in GAP_SENTINELS else F.col(c)
                         for c in GAP_COLUMNS])
