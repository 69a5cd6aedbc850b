"""Population stability.

PSI buckets are LEFT-closed with open ends (values below/above the reference
range fall into the end buckets), unlike the right-closed WOE bins. Edges are
quantiles of the *expected* side; percentages are floored at 1e-10 (max, not add).

Every variant runs as: one aggregate for the edges of all reference sides/columns
(<= buckets+1 numbers each reach the driver), then ONE tagged ``groupBy`` over the
union of both sides for all buckets/variables/comparisons.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.bins import left_closed_index
from riskframe.functions.exprs import PSI_BANDS, PSI_FLOOR, melt, psi_label
from riskframe.operators.binning import clean_double, dedupe_edges, exact_quantiles

DETAIL_COLS = ["bucket", "bin_edge_lower", "bin_edge_upper", "expected_count", "actual_count",
               "expected_pct", "actual_pct", "psi_contribution"]


def psi_edges(values: Sequence[float | None]) -> list[float]:
    return dedupe_edges(values)


def _fractions(buckets: int) -> list[float]:
    return [float(v) for v in np.linspace(0.0, 1.0, buckets + 1)]


def _bucket_expr(x: Column, edges: list[float]) -> Column:
    return left_closed_index(x, edges[1:-1])


def _edges_for(df: DataFrame, exprs: dict[str, Column], buckets: int, approx: bool = False) -> dict[str, list[float]]:
    """Reference-side edges for several columns/parts at once: exact quantiles from one
    value-count scan (or ``percentile_approx`` when ``approx``)."""
    fr = _fractions(buckets)
    if approx:
        row = df.agg(*[F.percentile_approx(e, fr, 100000).alias(k) for k, e in exprs.items()]).first()
        raw = {k: row[k] for k in exprs}
    else:
        raw = exact_quantiles(df, exprs, fr)
    return {k: psi_edges(raw[k]) if raw[k] is not None and raw[k][0] is not None else [] for k in exprs}


def _finish(counts: DataFrame, keys: list[str], edges: dict[tuple, list[float]], spark) -> DataFrame:
    """From ``(keys..., bucket, expected_count, actual_count)`` counts to the detail table."""
    grid_rows = []
    for key, e in edges.items():
        for i in range(max(len(e) - 1, 0)):
            grid_rows.append((*key, i, float(e[i]), float(e[i + 1])))
    schema = ", ".join(f"{k} string" for k in keys) + ", bucket int, bin_edge_lower double, bin_edge_upper double"
    grid = spark.createDataFrame(grid_rows, schema)
    full = grid.join(counts, on=[*keys, "bucket"], how="left").na.fill(0, ["expected_count", "actual_count"])
    w = Window.partitionBy(*keys)  # <= buckets rows per key
    ne, na = F.sum("expected_count").over(w), F.sum("actual_count").over(w)
    ep = F.greatest(F.try_divide(F.col("expected_count"), ne), F.lit(PSI_FLOOR))  # empty side -> floor; psi is NaN
    ap = F.greatest(F.try_divide(F.col("actual_count"), na), F.lit(PSI_FLOOR))
    return full.select(*keys, "bucket", "bin_edge_lower", "bin_edge_upper",
                       F.col("expected_count").cast("long").alias("expected_count"),
                       F.col("actual_count").cast("long").alias("actual_count"),
                       ep.alias("expected_pct"), ap.alias("actual_pct"),
                       ((ap - ep) * F.log(ap / ep)).alias("psi_contribution"),
                       ne.cast("long").alias("n_expected"), na.cast("long").alias("n_actual"))


def psi_buckets(expected: DataFrame, actual: DataFrame, col: str, buckets: int = 10,
                actual_col: str | None = None, approx: bool = False) -> DataFrame:
    """Bucket table of one score/column (missing values removed on both sides)."""
    acol = actual_col or col
    edges = _edges_for(expected, {"e": clean_double(col)}, buckets, approx)["e"]
    if len(edges) < 2:
        return expected.sparkSession.createDataFrame([], "bucket int, bin_edge_lower double, bin_edge_upper double, "
                                                         "expected_count long, actual_count long, expected_pct double, "
                                                         "actual_pct double, psi_contribution double, n_expected long, n_actual long")
    both = (expected.select(clean_double(col).alias("x"), F.lit(True).alias("_e"))
            .unionByName(actual.select(clean_double(acol).alias("x"), F.lit(False).alias("_e")))
            .where(F.col("x").isNotNull()))
    counts = (both.select(_bucket_expr(F.col("x"), edges).alias("bucket"), "_e")
              .groupBy("bucket").agg(F.count_if(F.col("_e")).alias("expected_count"),
                                     F.count_if(~F.col("_e")).alias("actual_count"))
              .withColumn("_key", F.lit("k")))
    d = _finish(counts, ["_key"], {("k",): edges}, expected.sparkSession)
    return d.drop("_key")


def psi_summary(detail: DataFrame, keys: Sequence[str] = (), bands=PSI_BANDS) -> DataFrame:
    """psi = sum of contributions (NaN when a side is empty), interpretation, sizes.
    A key with fewer than two distinct edges has no bucket rows and is absent (PSI 0 by definition)."""
    g = detail.groupBy(*keys).agg(
        F.sum("psi_contribution").alias("psi"), F.max("n_expected").alias("n_expected"),
        F.max("n_actual").alias("n_actual"))
    psi = F.when((F.col("n_expected") == 0) | (F.col("n_actual") == 0), F.lit(float("nan"))).otherwise(F.col("psi"))
    return g.withColumn("psi", psi).withColumn("interpretation", psi_label("psi", bands))


def calculate_psi_detailed(expected: DataFrame, actual: DataFrame, col: str, buckets: int = 10) -> tuple[DataFrame, DataFrame]:
    """(one summary row with psi, interpretation and sizes, bucket rows). A reference with fewer than two distinct edges
    has no buckets and psi 0; the sizes are those of the rows with a value."""
    detail = psi_buckets(expected, actual, col, buckets)
    size = lambda df, name: df.agg(F.count(clean_double(col)).alias(name))
    sizes = size(expected, "n_expected").withColumn("_k", F.lit(1)).join(size(actual, "n_actual").withColumn("_k", F.lit(1)), "_k")
    psi = psi_summary(detail).select("psi", F.lit(1).alias("_k"))
    rows = sizes.join(psi, "_k", "left")
    none = (F.col("n_expected") == 0) | (F.col("n_actual") == 0)
    value = F.when(none, F.lit(float("nan"))).otherwise(F.coalesce("psi", F.lit(0.0)))
    return rows.select(value.alias("psi"), "n_expected", "n_actual").withColumn("interpretation", psi_label("psi")), detail


def calculate_psi(expected: DataFrame, actual: DataFrame, col: str, buckets: int = 10, bands=PSI_BANDS) -> DataFrame:
    """One-row PSI; 0.0 when the reference has fewer than two distinct edges."""
    s = psi_summary(psi_buckets(expected, actual, col, buckets), bands=bands)
    one = expected.sparkSession.range(1).select(F.lit(1).alias("_k"))
    return one.join(s.withColumn("_k", F.lit(1)), on="_k", how="left").select(
        F.coalesce("psi", F.lit(0.0)).alias("psi"), F.coalesce("interpretation", F.lit(bands[0][1])).alias("interpretation"))


def variable_psi(expected: DataFrame, actual: DataFrame, columns: Sequence[str], buckets: int = 10,
                 detail: bool = False, bands=PSI_BANDS) -> DataFrame:
    """PSI per numeric column present in both frames, sorted desc. One edge job, one bucket job."""
    from pyspark.sql.types import BooleanType, NumericType
    cols = [c for c in columns if c in expected.columns and c in actual.columns
            and isinstance(expected.schema[c].dataType, NumericType)
            and not isinstance(expected.schema[c].dataType, BooleanType)]
    edges = _edges_for(expected, {c: clean_double(c) for c in cols}, buckets)
    live = [c for c in cols if len(edges[c]) >= 2]
    spark = expected.sparkSession
    # A constant (or empty) reference has a single bucket: PSI 0, stable.
    flat = spark.createDataFrame([(c, 0.0, bands[0][1]) for c in cols if c not in live],
                                 "variable string, psi double, interpretation string")
    if not live and not detail:
        return flat.orderBy("variable")

    def tagged(df, is_exp):
        return melt(df, [F.lit(is_exp).alias("_e")], {c: _bucket_expr(clean_double(c), edges[c]) for c in live},
                    name_col="variable", value_col="bucket")

    counts = (tagged(expected, True).unionByName(tagged(actual, False))
              .where(F.col("bucket").isNotNull())
              .groupBy("variable", "bucket")
              .agg(F.count_if(F.col("_e")).alias("expected_count"), F.count_if(~F.col("_e")).alias("actual_count")))
    d = _finish(counts, ["variable"], {(c,): edges[c] for c in live}, spark)
    if detail:
        return d
    found = psi_summary(d, ["variable"], bands).select("variable", "psi", "interpretation")
    return found.unionByName(flat).orderBy(F.col("psi").desc(), "variable")


# The three score comparisons of the drift report (name, expected part, actual part).
REPORT_COMPARISONS = (("score_psi_test_vs_train", "train", "test"),
                      ("score_psi_oot_vs_train", "train", "oot"),
                      ("score_psi_oot_vs_test", "test", "oot"))


def psi_report(df: DataFrame, score: str, split_col: str = "split", buckets: int = 10,
               comparisons=REPORT_COMPARISONS) -> DataFrame:
    """Bucket rows of every comparison with a ``comparison`` column, from ONE labelled frame.

    Edges of all reference parts come from one aggregate; each row is exploded into the
    comparisons it takes part in (at most two), bucketed by that comparison's edges and
    counted in one ``groupBy``."""
    refs = sorted({e for _, e, _ in comparisons})
    x = clean_double(score)
    edges_by_ref = _edges_for(df, {r: F.when(F.col(split_col) == r, x) for r in refs}, buckets)
    live = [(n, e, a) for n, e, a in comparisons if len(edges_by_ref[e]) >= 2]
    spark = df.sparkSession
    if not live:  # constant references have no buckets
        none = spark.createDataFrame([], "comparison string, bucket int, expected_count long, actual_count long")
        return _finish(none, ["comparison"], {}, spark)
    tags = []
    for n, e, a in live:
        tags.append(F.when(F.col(split_col) == e, F.struct(F.lit(n).alias("comparison"), F.lit(True).alias("_e"))))
        tags.append(F.when(F.col(split_col) == a, F.struct(F.lit(n).alias("comparison"), F.lit(False).alias("_e"))))
    ex = (df.select(x.alias("x"), F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())).alias("t"))
          .where(F.col("x").isNotNull())
          .select("x", "t.comparison", "t._e"))
    bucket = None
    for n, e, _ in live:
        b = _bucket_expr(F.col("x"), edges_by_ref[e])
        bucket = F.when(F.col("comparison") == n, b) if bucket is None else bucket.when(F.col("comparison") == n, b)
    counts = (ex.select("comparison", bucket.alias("bucket"), "_e")
              .groupBy("comparison", "bucket")
              .agg(F.count_if(F.col("_e")).alias("expected_count"), F.count_if(~F.col("_e")).alias("actual_count")))
    return _finish(counts, ["comparison"], {(n,): edges_by_ref[e] for n, e, _ in live}, spark)


def drift_report(df: DataFrame, score: str, split_col: str = "split", variables: Sequence[str] = (), buckets: int = 10,
                 comparisons=REPORT_COMPARISONS, variable_parts: tuple[str, str] = ("train", "oot"), bands=PSI_BANDS) -> DataFrame:
    """W6 in full, one row a finding: section "score" for each comparison of the score, section "variable" for each numeric
    variable between two parts. Columns: section, name, psi, interpretation. A constant reference has PSI 0."""
    scores = psi_summary(psi_report(df, score, split_col, buckets, comparisons), ["comparison"], bands)
    names = df.sparkSession.createDataFrame([(n,) for n, _, _ in comparisons], "name string")
    scores = names.join(scores.withColumnRenamed("comparison", "name"), "name", "left").select(
        F.lit("score").alias("section"), "name", F.coalesce("psi", F.lit(0.0)).alias("psi"),
        F.coalesce("interpretation", F.lit(bands[0][1])).alias("interpretation"))
    if not variables:
        return scores
    expected, actual = (df.where(F.col(split_col) == p) for p in variable_parts)
    found = variable_psi(expected, actual, variables, buckets, bands=bands)
    return scores.unionByName(found.select(F.lit("variable").alias("section"), F.col("variable").alias("name"), "psi", "interpretation"))


def psi_by_period(df: DataFrame, col: str, ts_col: str, baseline_end: str, window: str = "7 days",
                  buckets: int = 10) -> DataFrame:
    """Baseline edges from rows before ``baseline_end``; PSI of every tumbling window
    (aligned to the epoch, like Structured Streaming windows) against the baseline.
    Columns: window_start, psi, interpretation, n_expected, n_actual."""
    ts = F.col(ts_col)
    base = df.where(ts < F.lit(baseline_end).cast(df.schema[ts_col].dataType))
    edges = _edges_for(base, {"e": clean_double(col)}, buckets)["e"]
    spark = df.sparkSession
    if len(edges) < 2:
        return spark.createDataFrame([], "window_start string, psi double, interpretation string, n_expected long, n_actual long")
    b = _bucket_expr(clean_double(col), edges)
    exp_counts = base.where(clean_double(col).isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("expected_count"))
    act = (df.where(clean_double(col).isNotNull())
           .groupBy(F.window(ts, window).start.cast("string").alias("window_start"), b.alias("bucket"))
           .agg(F.count(F.lit(1)).alias("actual_count")))
    return window_psi(act, exp_counts, len(edges) - 1)


def window_psi(actual: DataFrame, expected: DataFrame, buckets: int) -> DataFrame:
    """PSI of every window from its counts (window_start, bucket, actual_count) against (bucket, expected_count)."""
    # Every window gets every bucket id (<= buckets rows per window, bounded by the time range).
    ids = F.array(*[F.lit(i) for i in range(buckets)])
    full = (actual.select("window_start").distinct().select("window_start", F.explode(ids).alias("bucket"))
            .join(expected, on="bucket", how="left")
            .join(actual, on=["window_start", "bucket"], how="left")
            .na.fill(0, ["expected_count", "actual_count"]))
    w = Window.partitionBy("window_start")
    ne, na = F.sum("expected_count").over(w), F.sum("actual_count").over(w)
    ep = F.greatest(F.try_divide(F.col("expected_count"), ne), F.lit(PSI_FLOOR))  # empty side -> floor; psi is NaN
    ap = F.greatest(F.try_divide(F.col("actual_count"), na), F.lit(PSI_FLOOR))
    d = full.select("window_start", ((ap - ep) * F.log(ap / ep)).alias("c"), ne.alias("ne"), na.alias("na"))
    return (d.groupBy("window_start").agg(F.sum("c").alias("psi"), F.max("ne").cast("long").alias("n_expected"),
                                          F.max("na").cast("long").alias("n_actual"))
            .withColumn("interpretation", psi_label("psi")))
