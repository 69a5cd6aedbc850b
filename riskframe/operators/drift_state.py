"""Mergeable drift state (W1-W6, T1 and the sink of T2).

A state is a folder: the frozen bucket edges of each variable, and additive counts (period, variable, bucket, n, late,
last) in one folder per batch of rows. A report over any two ranges of periods sums counts and never reads the rows
again; new days are appended, and a batch written twice replaces itself. The counts are bounded by periods x variables x
buckets, whatever the rows.

A row is late if its time is more than ``late_after`` before the latest time of the batches with smaller numbers; late rows
still count in their period. Rows without a time belong to no period and missing values to no bucket: neither is counted. A
variable whose reference has fewer than two distinct values has one bucket and PSI 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.exprs import PSI_BANDS, melt
from riskframe.operators.binning import clean_double
from riskframe.operators.drift import _bucket_expr, _edges_for, _finish, psi_summary, window_psi

Range = tuple[str | None, str | None]   # [from, to) in time, open where None
COUNTS = "period timestamp_ntz, variable string, bucket int, n long, late long, last timestamp_ntz, batch_id long"


@dataclass(frozen=True)
class DriftState:
    path: str
    edges: dict[str, list[float]]
    ts_col: str
    period: str

    @classmethod
    def create(cls, reference: DataFrame, path: str, columns: Sequence[str], ts_col: str, period: str = "1 day",
               buckets: int = 10) -> DriftState:
        """Freeze the edges of ``columns`` at the quantiles of ``reference`` (whose rows are not yet counted)."""
        edges = _edges_for(reference, {c: clean_double(c) for c in columns}, buckets)
        rows = [(c, [float(v) for v in edges[c]], ts_col, period) for c in columns]
        reference.sparkSession.createDataFrame(rows, "variable string, edges array<double>, ts_col string, period string").coalesce(1).write.parquet(f"{path}/edges")
        return cls(path, {c: e for c, e, _, _ in rows}, ts_col, period)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DriftState:
        rows = spark.read.parquet(f"{path}/edges").collect()  # one row a variable
        return cls(path, {r.variable: list(r.edges) for r in rows}, rows[0].ts_col, rows[0].period)

    def counts_of(self, df: DataFrame, late_before: F.Column | None = None) -> DataFrame:
        """Counts of the rows of ``df``: one scan, one grouping with partial sums."""
        ts = F.col(self.ts_col).cast("timestamp_ntz")
        late = F.coalesce(ts < late_before, F.lit(False)) if late_before is not None else F.lit(False)
        buckets = {c: _bucket_expr(clean_double(c), e) if len(e) >= 2 else F.when(clean_double(c).isNotNull(), 0)
                   for c, e in self.edges.items()}
        long = melt(df, [ts.alias("ts"), late.alias("is_late")], buckets, name_col="variable", value_col="bucket")
        return (long.where(F.col("bucket").isNotNull())
                .groupBy(F.window("ts", self.period).start.alias("period"), "variable", "bucket")
                .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_late").alias("late"), F.max("ts").alias("last")))

    def append(self, df: DataFrame, batch: int, late_after: str | None = None) -> None:
        """Add the rows of ``df`` as batch ``batch`` (0 or more). The same batch again replaces its counts, and since lateness
        looks at smaller batches only, a replay writes the same."""
        late_before = None
        if late_after is not None and batch > 0:
            last = self.counts(df.sparkSession).where(F.col("batch_id") < batch).agg(F.max("last")).first()[0]
            if last is not None:
                late_before = F.lit(last).cast("timestamp_ntz") - F.expr(f"INTERVAL {late_after}")
        self.counts_of(df, late_before).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts/batch_id={batch}")

    def counts(self, spark: SparkSession) -> DataFrame:
        """All counts as appended: a (period, variable, bucket) has one row a batch."""
        return spark.read.schema(COUNTS).option("basePath", f"{self.path}/counts").parquet(f"{self.path}/counts/batch_id=*")

    def report(self, spark: SparkSession, comparisons: Mapping[str, tuple[Range, Range]]) -> DataFrame:
        """W3/W6 bucket rows of every comparison name -> (expected range, actual range) and variable, from the counts alone."""
        c = self.counts(spark)
        tags = []
        for name, sides in comparisons.items():
            for is_e, (start, end) in zip((True, False), sides):
                inside = F.lit(True)
                if start is not None:
                    inside &= F.col("period") >= F.lit(start).cast("timestamp_ntz")
                if end is not None:
                    inside &= F.col("period") < F.lit(end).cast("timestamp_ntz")
                tags.append(F.when(inside, F.struct(F.lit(name).alias("comparison"), F.lit(is_e).alias("_e"))))
        summed = (c.select("variable", "bucket", "n", F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())).alias("t"))
                  .groupBy(F.col("t.comparison").alias("comparison"), "variable", "bucket")
                  .agg(F.sum(F.when(F.col("t._e"), F.col("n")).otherwise(0)).alias("expected_count"),
                       F.sum(F.when(F.col("t._e"), 0).otherwise(F.col("n"))).alias("actual_count")))
        live = {(name, v): e for name in comparisons for v, e in self.edges.items() if len(e) >= 2}
        return _finish(summed, ["comparison", "variable"], live, spark)

    def summary(self, spark: SparkSession, comparisons: Mapping[str, tuple[Range, Range]], score: str | None = None) -> DataFrame:
        """The drift report: (section, comparison, variable, psi, interpretation, n_expected, n_actual); section is "score"
        for the variable ``score``, else "variable". Constant references have PSI 0 and no sizes."""
        found = psi_summary(self.report(spark, comparisons), ["comparison", "variable"])
        flat = [(name, v, 0.0, PSI_BANDS[0][1]) for name in comparisons for v, e in self.edges.items() if len(e) < 2]
        if flat:
            found = found.unionByName(spark.createDataFrame(flat, "comparison string, variable string, psi double, interpretation string"),
                                      allowMissingColumns=True)
        section = F.when(F.col("variable").eqNullSafe(F.lit(score)), "score").otherwise("variable")
        return found.select(section.alias("section"), "comparison", "variable", "psi", "interpretation", "n_expected", "n_actual")

    def by_period(self, spark: SparkSession, variable: str, baseline: Range) -> DataFrame:
        """T1 from the counts: PSI of every period against the periods of ``baseline``, and how many rows came late.
        Columns: window_start, psi, interpretation, n_expected, n_actual, late_rows."""
        c = self.counts(spark).where(F.col("variable") == variable)
        base = c
        if baseline[0] is not None:
            base = base.where(F.col("period") >= F.lit(baseline[0]).cast("timestamp_ntz"))
        if baseline[1] is not None:
            base = base.where(F.col("period") < F.lit(baseline[1]).cast("timestamp_ntz"))
        expected = base.groupBy("bucket").agg(F.sum("n").alias("expected_count"))
        start = F.col("period").cast("string").alias("window_start")
        actual = c.groupBy(start, "bucket").agg(F.sum("n").alias("actual_count"))
        late = c.groupBy(start).agg(F.sum("late").alias("late_rows"))
        psi = window_psi(actual, expected, max(1, len(self.edges[variable]) - 1))
        return psi.join(late, "window_start")
