"""Connected components of a link table, as joins that keep every step distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import slim, slim_checkpoint
from riskframe.session import reliable_checkpoint


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``links(a, b)``; ``comp`` is the smallest node reachable.

    Each round every node takes the smallest label of itself and its neighbours, then the label of
    its label (pointer jumping), so chains shorten by halves. Rounds are cut by checkpoint().
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    both = slim_checkpoint(both)
    labels = slim_checkpoint(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("comp").alias("heard"))
        step = labels.join(heard, "node").select("node", F.least("comp", "heard").alias("to"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("to"), F.col("comp").alias("further"))
        step = step.join(jump, "to").select("node", F.least("to", "further").alias("comp"), "was")
        step = reliable_checkpoint(step)
        rows, moved = step.agg(F.count(F.lit(1)), F.count(F.when(F.col("comp") != F.col("was"), 1))).first()
        labels = slim(step.select("node", "comp"), rows)
        if not moved:
            return labels
