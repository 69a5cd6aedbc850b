"""Mixing sources to target weights by weighted fair queueing.

A document's size is its number of words. The budget (all sizes, unless given) is shared between the
sources by weight; no source gets more than ``epochs`` times its size, and what it leaves is shared
again by weight. This water level needs no loop: sources in order of size / weight are full as
long as filling all others to the same level stays within the budget.

Within a source documents are shuffled by a hash of their id and served up to ``epochs`` times over.
A document's virtual finish time is the words its source has served when it ends, divided by the
source's target; the queue is sorted by it over all sources (a range sort) and cut where the budget is
used up, which is at virtual time 1, since the targets add up to the budget. The document being served
at the cut is taken in part, so that each source ends within one word of its target.

Running totals within a source are sums by (source, hash bucket) plus a window inside each bucket, and
buckets become more with the rows, so a hot source is spread over tasks.

Defined results: a null text has size 0 and nothing of it is taken. Null is a source of its own, last in order.
Rows that repeat an id are served one after the other. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.common import WORD_RE, text_or_empty
from riskframe.session import reliable_checkpoint

# Fixed values of the contract: weights by rank of the source, and how often a document may be used.
WEIGHTS = (1, 2, 3)
EPOCHS = 3
#: Rows of a source that one window sorts at a time, about.
BUCKET_ROWS = 50_000


def source_targets(sized: DataFrame, epochs: int = EPOCHS, budget: int | None = None) -> DataFrame:
    """One row per source: source, source_size, weight, target."""
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight.cast("long"))
    total = F.lit(budget) if budget is not None else F.sum("source_size").over(every)
    s = s.withColumn("total", total.cast("decimal(38,0)")).withColumn("cap", (F.col("source_size") * epochs).cast("decimal(20,0)"))
    upto = Window.orderBy(F.col("source_size") / F.col("weight")).rangeBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("caps_upto", F.sum("cap").over(upto)).withColumn(
        "weights_after", F.sum("weight").over(every) - F.sum("weight").over(upto))
    w = F.col("weight").cast("decimal(10,0)")
    full = F.col("caps_upto") * w + F.col("cap") * F.col("weights_after").cast("decimal(10,0)") <= F.col("total") * w
    s = s.withColumn("full", full)
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    share = left.cast("double") * F.col("weight") / open_weight
    return s.select("source", "source_size", "weight",
                    F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def fair_queue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               epochs: int = EPOCHS, budget: int | None = None) -> DataFrame:
    """One row per row of ``docs``, in the order of the queue: doc_id, size, source, source_size, target,
    virtual_finish (of its first use), taken (words of it in the mix, repeats counted)."""
    sized = reliable_checkpoint(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD_RE)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("deal")))
    digits = max(1, math.ceil(math.log(max(1, sized.count() / BUCKET_ROWS), 16)))
    rows = sized.withColumn("bucket", F.substring("deal", 1, digits))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
    plan = buckets.alias("b").join(source_targets(sized, epochs, budget).alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
    plan = plan.select(F.col("b.source").alias("of"), F.col("bucket").alias("part"), "base", "source_size", "target")

    inside = Window.partitionBy("source", "bucket").orderBy("deal", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    served = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    served = served.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("part")))
    start = F.col("base") + F.col("ahead")
    limit = F.floor("target")
    uses = [F.greatest(F.lit(0), F.least(F.col("size"), limit - start - F.col("source_size") * e)) for e in range(epochs)]
    taken = uses[0]
    for u in uses[1:]:
        taken = taken + u
    finish = F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target"))
    return served.select("doc_id", "size", "source", "source_size", "target", finish.alias("virtual_finish"),
                         taken.cast("long").alias("taken"), "deal").orderBy(F.col("virtual_finish").asc_nulls_last(), "deal").drop("deal")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as rows of ``docs``: each document as often as it is taken whole; a part of half or more counts as whole."""
    q = fair_queue(docs, id_col, text_col, source_col)
    uses = q.filter("taken > 0").groupBy("doc_id", "source", "size").agg(
        F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("rows"))
    share = F.round(F.col("taken") / (F.col("size") * F.col("rows"))).cast("int")
    uses = uses.select(F.col("doc_id").alias("__id"), F.col("source").alias("__of"), F.col("size").alias("__size"), share.alias("__uses"))
    size = F.regexp_count(text_or_empty(text_col), F.lit(WORD_RE)).cast("long")
    tagged = docs.withColumn("__own", size)
    rows = tagged.join(uses.filter("__uses > 0"), F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__size"))
                       & F.col(source_col).cast("string").eqNullSafe(F.col("__of")))
    return rows.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__uses")))).select(*docs.columns)
