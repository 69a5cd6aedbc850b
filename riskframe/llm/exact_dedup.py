"""Exact deduplication by a 128-bit content hash with byte comparison.

The text is normalised by deleting white space, hashed to 128 bits, and only slim rows
(hash, id, length) are grouped. Texts of groups with several documents are then compared
byte by byte with the text that stays: a row that differs (a hash collision) leaves the
group and is grouped by its whole normalised text instead.

Hot groups: group figures are aggregates with a map-side part; the join that brings them
back has one row per group on one side, so a hot key is split by Spark's skew join; the text that
stays is sent once per SALT_ROWS members, and members are dealt over these copies.

Defined results: a null text is the empty text, and all empty texts are equal. A null id sorts
last among ties. Rows that repeat an id with an equal text of the same length are one document and
give one row (each row counts in ``group_size``). An empty table gives an empty result.
Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import WHITE, rows_with_ids, text_or_empty
from riskframe.session import reliable_checkpoint

#: Members of a group that share one copy of the text they are compared with.
SALT_ROWS = 256


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.md5(text.cast("binary"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn=content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest id.
    ``hash_fn`` maps the normalised text to the grouping hash (a weak one in tests).
    """
    norm = normalised(text_or_empty(text_col))
    hashed = docs.select(
        F.col(id_col).alias("doc_id"), F.length(text_or_empty(text_col)).alias("n"),
        hash_fn(norm).alias("h"), F.sha2(norm.cast("binary"), 256).alias("sha"))
    slim = reliable_checkpoint(hashed.groupBy("doc_id", "n", "h", "sha").agg(F.count(F.lit(1)).alias("copies")))
    order = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    groups = slim.groupBy("h").agg(
        F.sum("copies").alias("size"), F.count(F.lit(1)).alias("members"), F.min(order).alias("best"))

    several = reliable_checkpoint(slim.join(groups.filter("members > 1").drop("size"), "h").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "n"), F.ceil(F.col("members") / SALT_ROWS))))
    collided = reliable_checkpoint(_collisions(docs, several, norm, id_col, text_col))

    # Rows that differ from the text that stays are grouped by their whole normalised text.
    moved = collided.groupBy("norm").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("best"))
    moved_rows = collided.join(moved, "norm").select("doc_id", "n", "sha", F.col("best").alias("b2"), F.col("size").alias("s2"))
    lost = collided.groupBy("h").agg(F.count(F.lit(1)).alias("lost"))

    base = (slim.join(groups, "h").join(lost, "h", "left")
            .join(moved_rows.withColumnRenamed("doc_id", "mid").withColumnRenamed("n", "mn").withColumnRenamed("sha", "msha"),
                  F.col("doc_id").eqNullSafe(F.col("mid")) & (F.col("n") == F.col("mn")) & (F.col("sha") == F.col("msha")), "left"))
    best = F.when(F.col("s2").isNotNull(), F.col("b2")).otherwise(F.col("best"))
    size = F.when(F.col("s2").isNotNull(), F.col("s2")).otherwise(F.col("size") - F.coalesce("lost", F.lit(0)))
    return base.select(
        "doc_id", best["id"].alias("keep_id"), size.alias("group_size"),
        (F.col("doc_id").eqNullSafe(best["id"]) & (F.col("n") == -best["n"])).alias("kept"),
        F.col("sha").alias("text_sha256"))


def _collisions(docs: DataFrame, several: DataFrame, norm: Column, id_col: str, text_col: str) -> DataFrame:
    """Members of groups whose normalised text differs from that of the row that stays, with their texts."""
    raw = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ids = several.select("doc_id").filter("doc_id is not null").distinct()
    raw = rows_with_ids(raw.filter("doc_id is not null"), ids, "doc_id", ids.count()).unionByName(
        raw.filter("doc_id is null"))
    text = text_or_empty("text")
    texts = raw.select("doc_id", F.length(text).alias("n"), normalised(text).alias("norm")).withColumn(
        "sha", F.sha2(F.col("norm").cast("binary"), 256))
    same_row = (F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("s.n") == F.col("t.n"))
                & (F.col("s.sha") == F.col("t.sha")))
    members = several.alias("s").join(texts.alias("t"), same_row).select(
        "s.doc_id", "s.n", "s.h", "s.sha", "s.salt", "s.members", "s.best", "t.norm")
    keeper = members.filter(F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("n") == -F.col("best.n")))
    copies = F.sequence(F.lit(0).cast("long"), (F.ceil(F.col("members") / SALT_ROWS) - 1).cast("long"))
    keeper = (keeper.select("h", F.col("norm").alias("kept_norm"), F.explode(copies).alias("salt"))
              .dropDuplicates(["h", "salt"]))
    differs = members.join(keeper, ["h", "salt"]).filter(F.col("norm") != F.col("kept_norm"))
    return differs.select("doc_id", "n", "h", "sha", "norm")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keep = exact_groups(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    sha = F.sha2(normalised(text_or_empty(text_col)).cast("binary"), 256)
    tagged = docs.withColumn("__sha_own", sha)
    kept = tagged.join(keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__sha_own") == F.col("__sha")))
    return kept.dropDuplicates([id_col, "__sha_own"]).select(*docs.columns)
