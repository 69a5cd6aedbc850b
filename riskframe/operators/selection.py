"""Information value, correlation and VIF selection (F1-F8).

Spark does the row work (one shuffle for IV of all features, two scans for the
correlation matrix); the greedy correlation and VIF pruning loops then run on
the p x p matrix on the driver, with zero further Spark jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from riskframe.functions.exprs import IV_EPS, iv_strength
from riskframe.operators.binning import clean_double
from riskframe.operators.curves import prefix_below
from riskframe.session import persist

CONSTANT_TOL = 1e-13   # a variance below this share of the second moment is rounding error
VIF_SINGULAR_TOL = 1e-10


def class_totals(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 0).alias("g"), F.count_if(F.col(target) == 1).alias("b")).first()
    if row["g"] == 0 or row["b"] == 0:
        raise ValueError("Target must contain both classes")
    return row["g"], row["b"]


def calculate_iv(df: DataFrame, target: str, features: Sequence[str] | None = None, eps: float = IV_EPS,
                 totals: tuple[int, int] | None = None) -> DataFrame:
    """IV per feature over groups of the raw feature *value* (bins with equal WOE merge).

    IV = sum over groups of (g% - b%) * ln(g% / b%), g% = (good+eps)/(G+eps). Null values form no
    group but count in the totals. Columns: feature, iv, n_bins, strength; sorted by iv desc."""
    feats = [c for c in (features or [c for c in df.columns if c != target]) if c in df.columns and c != target]
    G, B = totals or class_totals(df, target)
    y = F.col(target)
    types = {f.name: f.dataType for f in df.schema.fields}
    # Numbers stay doubles and categories strings: one generator, no per-value string cast.
    arr = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 (F.col(c).cast("double") if isinstance(types[c], (NumericType, BooleanType)) else F.lit(None).cast("double")).alias("num"),
                 (F.lit(None).cast("string") if isinstance(types[c], (NumericType, BooleanType)) else F.col(c).cast("string")).alias("cat"))
        for c in feats])
    grouped = (
        df.select(y.alias("__y"), F.inline(arr))
        .where(F.col("num").isNotNull() | F.col("cat").isNotNull())
        .groupBy("feature", "num", "cat")
        .agg(F.count_if(F.col("__y") == 0).alias("good"), F.count_if(F.col("__y") == 1).alias("bad"))
    )
    e = F.lit(eps)
    gp = (F.col("good") + e) / (F.lit(float(G)) + e)
    bp = (F.col("bad") + e) / (F.lit(float(B)) + e)
    iv = grouped.groupBy("feature").agg(F.sum((gp - bp) * F.log(gp / bp)).alias("iv"),
                                        F.count(F.lit(1)).alias("n_bins"))
    # Features whose values are all null still get a row (IV 0, no bins).
    allf = df.sparkSession.createDataFrame([(c,) for c in feats], "feature string")
    return (allf.join(iv, on="feature", how="left")
            .select("feature", F.coalesce("iv", F.lit(0.0)).alias("iv"), F.coalesce("n_bins", F.lit(0)).alias("n_bins"))
            .withColumn("strength", iv_strength("iv"))
            .orderBy(F.col("iv").desc(), F.col("feature")))


def select_by_iv(iv_table: DataFrame, iv_min: float = 0.02, iv_max: float = 0.5) -> DataFrame:
    """inclusive range, IV order kept."""
    return iv_table.where((F.col("iv") >= iv_min) & (F.col("iv") <= iv_max)).orderBy(F.col("iv").desc(), "feature")


def _co_moment_rows(features: Sequence[str], centre: np.ndarray, scale: np.ndarray):
    """Task-side sums over all pairs i < j: a task keeps 4 p x p arrays, whatever its rows, and emits one row a pair."""
    p = len(features)
    upper = np.triu_indices(p, 1)

    def run(batches):
        n, sx, sxx, sxy = (np.zeros((p, p)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in features])
            seen = ~np.isnan(x)
            z = np.where(seen, (x - centre) / scale, 0.0)
            m = seen.astype(float)
            n += m.T @ m
            sx += z.T @ m          # [i, j]: sum of i over the rows where j is present
            sxx += (z * z).T @ m
            sxy += z.T @ z
        i, j = upper
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (i.astype(np.int32), j.astype(np.int32), n[upper], sx[upper], sx.T[upper],
                                   sxx[upper], sxx.T[upper], sxy[upper])],
            names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])
    return run


def pair_moments(values: DataFrame, features: Sequence[str]) -> DataFrame:
    """Additive co-moments of every pair over its complete rows, in two scans at any width: one for the centre and
    scale of each column (so that sums neither overflow nor cancel), one for the sums of standardised values.
    Columns: i, j (positions, i < j), n, sx, sy, sxx, syy, sxy. Tables of the parts of a table can be summed."""
    feats = list(features)
    spread = lambda x: F.max(x) - F.min(x)  # noqa: E731  (squares of the values may overflow)
    stats = values.agg(*[f(F.col(c)).alias(f"{k}{i}") for i, c in enumerate(feats)
                         for k, f in (("m", F.avg), ("s", spread))]).first()
    get = lambda k, default: np.array([default if stats[f"{k}{i}"] is None else stats[f"{k}{i}"]
                                       for i in range(len(feats))], dtype=float)
    scale = get("s", 1.0)
    rows = values.mapInArrow(_co_moment_rows(feats, get("m", 0.0), np.where(scale == 0.0, 1.0, scale)),
                             "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
    return rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def corr_from_moments(moments: DataFrame) -> DataFrame:
    """(i, j, corr): null where a side is constant over the complete rows or none are complete."""
    vx = F.col("sxx") - F.col("sx") * F.try_divide(F.col("sx"), F.col("n"))
    vy = F.col("syy") - F.col("sy") * F.try_divide(F.col("sy"), F.col("n"))
    cov = F.col("sxy") - F.col("sx") * F.try_divide(F.col("sy"), F.col("n"))
    varies = (vx > F.col("sxx") * CONSTANT_TOL) & (vy > F.col("syy") * CONSTANT_TOL)
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(vx) / F.sqrt(vy)))
    return moments.select("i", "j", F.when(varies & ~F.isnan(cov), r).alias("corr"))


def rank_correlations(values: DataFrame, features: Sequence[str], pairs: Sequence[tuple[int, int]]) -> list[Row]:
    """Rows (i, j, corr), one a pair, of Spearman's rank correlation over each pair's complete rows, all pairs in one job.

    Rows collapse to weighted distinct (pair, x, y) before the shuffle; the average rank of a value within its pair
    comes from the prefix sums over score ranges, so no pair is sorted in one task."""
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(features[i]).alias("x"), F.col(features[j]).alias("y"))
                      for i, j in pairs])
    # Zero has two signs that compare equal but hash apart.
    distinct = persist(values.select(F.inline(cells)).where(F.col("x").isNotNull() & F.col("y").isNotNull())
                       .select("i", "j", (F.col("x") + 0.0).alias("x"), (F.col("y") + 0.0).alias("y"))
                       .groupBy("i", "j", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("w")))

    def ranks(side: str) -> DataFrame:
        ones = distinct.groupBy("i", "j", side).agg(F.sum("w").alias("c"))
        below = prefix_below(ones, side, ["i", "j"], ["c"], persist_input=False)
        # Centred on the middle rank: the sums then need no correction for the mean.
        return below.select("i", "j", side, (F.col("c_below") + F.col("c") / 2.0 - F.col("c_total") / 2.0).alias(f"r{side}"))

    w, rx, ry = F.col("w"), F.col("rx"), F.col("ry")
    sums = (distinct.join(ranks("x"), ["i", "j", "x"]).join(ranks("y"), ["i", "j", "y"])
            .groupBy("i", "j").agg(F.sum(w * rx * rx).alias("sxx"), F.sum(w * ry * ry).alias("syy"), F.sum(w * rx * ry).alias("sxy")))
    found = sums.select("i", "j", F.when((F.col("sxx") > 0) & (F.col("syy") > 0),
                                         F.col("sxy") / F.sqrt("sxx") / F.sqrt("syy")).alias("corr")).collect()
    distinct.unpersist()
    return found


def correlation_matrix(df: DataFrame, features: Sequence[str], method: str = "pearson") -> np.ndarray:
    """p x p correlation matrix over pairwise-complete rows (as in pandas), at any width.

    Pearson: two scans (``pair_moments``). Spearman: MLlib ranks (average ranks on ties) of all columns without
    missing values at once; the pairs with a column that has some, in one job over their complete rows
    (``rank_correlations``). Other methods raise."""
    feats = list(features)
    p = len(feats)
    if p == 0:
        return np.zeros((0, 0))
    if method not in ("pearson", "spearman"):
        raise ValueError(f"Unsupported correlation method: {method}")
    values = df.select(*[clean_double(c).alias(c) for c in feats])
    m = np.full((p, p), np.nan)
    np.fill_diagonal(m, 1.0)
    if method == "spearman":
        gaps = values.agg(*[F.count_if(F.col(c).isNull()).alias(f"g{i}") for i, c in enumerate(feats)], F.count(F.lit(1)).alias("n")).first()
        full = [i for i in range(p) if gaps["n"] and not gaps[f"g{i}"]]
        if len(full) > 1:
            vec = VectorAssembler(inputCols=[feats[i] for i in full], outputCol="__v").transform(values.select(*[feats[i] for i in full]))
            m[np.ix_(full, full)] = Correlation.corr(vec, "__v", method).first()[0].toArray()
        pairs = [(i, j) for i in range(p) for j in range(i + 1, p) if gaps[f"g{i}"] or gaps[f"g{j}"]]
        found = rank_correlations(values, feats, pairs) if pairs else []
    else:
        found = corr_from_moments(pair_moments(values, feats)).collect() if p > 1 else []  # one row a pair of columns
    for r in found:
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = np.nan if r["corr"] is None else r["corr"]
    for i in range(p):  # constant columns have undefined correlation
        if p > 1 and np.all(np.isnan(np.delete(m[i], i))):
            m[i, i] = np.nan
    return m


def correlation_pairs(df: DataFrame, features: Sequence[str], method: str = "pearson") -> DataFrame:
    """Long form of the matrix: (feature_a, feature_b, corr) for a < b in column order."""
    m = correlation_matrix(df, features, method)
    rows = [(a, b, None if np.isnan(m[i, j]) else float(m[i, j]))
            for i, a in enumerate(features) for j, b in enumerate(features) if i < j]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def prune_by_correlation_matrix(features: Sequence[str], corr: np.ndarray, threshold: float = 0.8) -> list[str]:
    """in column order, drop a column iff a kept earlier column has |r| > threshold (NaN never drops)."""
    kept: list[int] = []
    for j in range(len(features)):
        if not any(abs(corr[i, j]) > threshold for i in kept if not np.isnan(corr[i, j])):
            kept.append(j)
    return [features[j] for j in kept]


def prune_by_correlation(df: DataFrame, features: Sequence[str], threshold: float = 0.8,
                         method: str = "pearson") -> list[str]:
    return prune_by_correlation_matrix(list(features), correlation_matrix(df, features, method), threshold)


def vif_from_corr(corr: np.ndarray) -> np.ndarray:
    """VIF_j = 1 / (1 - R^2_j) of column j on the others with intercept, from the correlation matrix.
    A single feature gets 1.0; a constant column (NaN row) or R^2 >= 1 gets inf."""
    p = corr.shape[0]
    if p == 1:
        return np.array([1.0])
    out = np.empty(p)
    const = np.array([np.isnan(corr[i, i]) or np.all(np.isnan(np.delete(corr[i], i))) for i in range(p)])
    for j in range(p):
        if const[j]:
            out[j] = np.inf
            continue
        others = [i for i in range(p) if i != j and not const[i]]
        if not others:
            out[j] = 1.0
            continue
        sub = np.nan_to_num(corr[np.ix_(others, others)])
        r = np.nan_to_num(corr[others, j])
        r2 = float(r @ np.linalg.pinv(sub, rcond=1e-12, hermitian=True) @ r)
        out[j] = np.inf if 1.0 - r2 <= VIF_SINGULAR_TOL else 1.0 / (1.0 - r2)
    return out


def calculate_vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    feats = list(features)
    v = vif_from_corr(correlation_matrix(df, feats)) if feats else np.array([])
    return df.sparkSession.createDataFrame([(f, float(x)) for f, x in zip(feats, v)], "feature string, vif double")


def prune_by_vif_matrix(features: Sequence[str], corr: np.ndarray, threshold: float = 10.0,
                        max_iter: int = 10) -> list[str]:
    """drop the max-VIF feature while it exceeds the threshold, at most ``max_iter`` drops;
    ties go to the first. Sub-matrices of one correlation matrix; no new Spark job."""
    remaining = list(range(len(features)))
    for _ in range(max_iter):
        if not remaining:
            break
        v = vif_from_corr(corr[np.ix_(remaining, remaining)])
        k = int(np.argmax(v))
        if v[k] <= threshold:
            break
        remaining.pop(k)
    return [features[i] for i in remaining]


def prune_by_vif(df: DataFrame, features: Sequence[str], threshold: float = 10.0, max_iter: int = 10) -> list[str]:
    feats = list(features)
    return prune_by_vif_matrix(feats, correlation_matrix(df, feats), threshold, max_iter)


def select_features(df: DataFrame, target: str, features: Sequence[str] | None = None, iv_min: float = 0.02,
                    iv_max: float = 0.5, correlation_threshold: float = 0.8,
                    vif_threshold: float = 10.0) -> tuple[list[str], DataFrame]:
    """F8: IV -> IV range -> correlation pruning (IV order) -> VIF pruning.
    Three Spark jobs (totals, IV, one correlation matrix reused by both pruning steps)."""
    iv = calculate_iv(df, target, features)
    selected = [r["feature"] for r in select_by_iv(iv, iv_min, iv_max).select("feature").collect()]
    if not selected:
        return [], iv
    corr = correlation_matrix(df, selected)
    kept = prune_by_correlation_matrix(selected, corr, correlation_threshold)
    idx = [selected.index(c) for c in kept]
    final = prune_by_vif_matrix(kept, corr[np.ix_(idx, idx)], vif_threshold)
    return final, iv
