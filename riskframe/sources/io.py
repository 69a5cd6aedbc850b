"""Sources, sinks and artefact round-trips.

All artefacts are tables: encoder bins, PSI buckets and metric reports are small
DataFrames written as Parquet or JSON Lines, so they load back into Spark (and
into any engine) without a pickle in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def load_data(spark: SparkSession, path: str, fmt: str | None = None, schema: StructType | None = None,
              header: bool = True) -> DataFrame:
    """Read a table. Parquet carries its schema; CSV/JSON take an explicit one when given
    (no inference pass over the data when a schema is supplied)."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "json" if path.endswith((".json", ".jsonl")) else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", header).option("inferSchema", schema is None).csv(path)
    return reader.format(fmt).load(path)


def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: list[str] | None = None, single_file: bool = False) -> None:
    """Write a table. ``single_file`` is only for small report tables (threshold CSV)."""
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def load_or_create_clean(spark: SparkSession, raw_path: str, clean_path: str,
                         clean_fn: Callable[[DataFrame], DataFrame], force_reload: bool = False) -> DataFrame:
    """Reuse the cleaned Parquet table if present, else clean the raw one and persist it."""
    if not force_reload and _exists(spark, clean_path):
        return spark.read.parquet(clean_path)
    cleaned = clean_fn(load_data(spark, raw_path))
    cleaned.write.mode("overwrite").parquet(clean_path)
    return spark.read.parquet(clean_path)


def save_json_table(df: DataFrame, path: str) -> None:
    """Small artefact tables (bins, PSI buckets, metric reports) as JSON Lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def load_json_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
