"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import reliable_checkpoint

# Fixed values of the query contracts: white space, and its complement as a word.
WHITE = " \t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"

#: Ids of up to so many rows are broadcast as a filter (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000


#: Rows of a slim table that one task of the next step reads, about.
SLIM_ROWS = 200_000


def slim_checkpoint(df: DataFrame) -> DataFrame:
    """Checkpoint of a slim table, read back in as many partitions as its rows need, so that steps of a
    loop do not write a set of shuffle files for every nearly empty partition."""
    kept = reliable_checkpoint(df)
    return slim(kept, kept.count())


def slim(kept: DataFrame, rows: int) -> DataFrame:
    """``kept`` of so many rows in as few partitions as they need."""
    return kept.coalesce(max(1, -(-rows // SLIM_ROWS)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_crc32(col: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def rows_with_ids(df: DataFrame, ids: DataFrame, key: str, n_ids: int, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (``left_anti``: is not); the caller has counted ``n_ids`` of them.

    Up to BROADCAST_IDS ids travel to the rows, so that only the rows kept are shuffled
    later; beyond that both sides are shuffled by the key.
    """
    side = ids.select(key)
    return df.join(F.broadcast(side) if n_ids <= BROADCAST_IDS else side.hint("shuffle_merge"), key, how)
