"""Expected loss EL = PD x EAD x LGD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.bins import linspace

# Default assumptions of the constant-EAD/LGD variant and the sensitivity grid.
DEFAULT_EAD = 10000.0
DEFAULT_LGD = 0.45
SENS_EAD_RANGE = (5000.0, 50000.0)
SENS_LGD_RANGE = (0.2, 0.6)
SENS_POINTS = 5
ASSUMPTION_NOTE = "One EAD and one LGD are applied to every account; use account-level figures for a portfolio estimate."


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def expected_loss(pd_col, ead, lgd) -> Column:
    """L1: column expression; each argument is a column name, Column or constant."""
    return _c(pd_col) * _c(ead) * _c(lgd)


def with_expected_loss(df: DataFrame, pd_col, ead, lgd, out: str = "el") -> DataFrame:
    return df.withColumn(out, expected_loss(pd_col, ead, lgd))


def portfolio_expected_loss(df: DataFrame, pd_col, ead, lgd) -> DataFrame:
    """L2: one-row total (nulls skipped)."""
    return df.agg(F.sum(expected_loss(pd_col, ead, lgd)).alias("total_el"))


def expected_loss_by_group(df: DataFrame, pd_col, ead, lgd, group_col: str, with_total: bool = False) -> DataFrame:
    """L3: per group: n_accounts (non-null EL), total_ead, total_el, avg_pd, avg_lgd, el_pct_of_ead.
    ``with_total`` adds a grand-total row (group = null) through ``rollup`` in the same aggregate."""
    el = expected_loss(pd_col, ead, lgd)
    aggs = [F.count(el).alias("n_accounts"), F.sum(_c(ead)).alias("total_ead"), F.sum(el).alias("total_el"),
            F.avg(_c(pd_col)).alias("avg_pd"), F.avg(_c(lgd)).alias("avg_lgd")]
    g = df.rollup(group_col) if with_total else df.groupBy(group_col)
    return g.agg(*aggs).withColumn("el_pct_of_ead", F.try_divide(F.col("total_el"), F.col("total_ead")))


def expected_loss_by_band(df: DataFrame, pd_col, ead, lgd, band_col: str = "risk_band") -> DataFrame:
    return expected_loss_by_group(df, pd_col, ead, lgd, band_col)


def sensitivity_analysis(df: DataFrame, pd_col: str, ead_range=SENS_EAD_RANGE, lgd_range=SENS_LGD_RANGE,
                         n_points: int = SENS_POINTS, approx_median: bool = False) -> DataFrame:
    """L4: EL over an n x n grid of constant EAD and LGD.

    EL = pd * ead * lgd is a non-negative scaling of pd, so mean, total and median
    over the grid are the pd statistics times ead*lgd: ONE aggregate over the rows,
    joined to the n^2-row parameter grid (never rows x grid)."""
    p = F.col(pd_col).cast("double")
    if approx_median:
        stats = df.agg(F.avg(p).alias("_m"), F.sum(p).alias("_s"), F.percentile_approx(p, 0.5, 100000).alias("_med"))
    else:  # exact median from distributed value counts; mean and sum from the same aggregate pass
        from riskframe.operators.binning import exact_quantiles
        med = exact_quantiles(df, {"p": p}, [0.5])["p"][0]
        stats = df.agg(F.avg(p).alias("_m"), F.sum(p).alias("_s")).withColumn("_med", F.lit(med).cast("double"))
    stats = stats.withColumn("_k", F.lit(1))
    grid = [(e, g) for e in linspace(*ead_range, n_points) for g in linspace(*lgd_range, n_points)]
    gdf = df.sparkSession.createDataFrame(grid, "ead double, lgd double").withColumn("_k", F.lit(1))
    j = gdf.join(stats, on="_k").drop("_k")
    scale = F.col("ead") * F.col("lgd")
    return j.select("ead", "lgd", (F.col("_m") * scale).alias("mean_el"), (F.col("_s") * scale).alias("total_el"),
                    (F.col("_med") * scale).alias("median_el"))


def el_with_assumptions(df: DataFrame, pd_col: str, ead: float = DEFAULT_EAD, lgd: float = DEFAULT_LGD) -> DataFrame:
    """Total and mean EL with constant EAD/LGD, with the assumptions as columns."""
    el = expected_loss(pd_col, ead, lgd)
    return df.agg(F.sum(el).alias("total_expected_loss"), F.avg(el).alias("mean_expected_loss_per_account")).select(
        "*", F.lit(float(ead)).alias("ead"), F.lit(float(lgd)).alias("lgd"), F.lit(ASSUMPTION_NOTE).alias("note"))


def el_by_decision(df: DataFrame, pd_col, ead, lgd, decision_col: str = "decision") -> DataFrame:
    """Per decision n_accounts, total_ead, total_el, avg_pd and
    el_saved_vs_approve_all = total EL of all rows - EL of the group.
    The portfolio total comes from a ``rollup`` row of the same aggregate (no second scan,
    no single-partition window over rows)."""
    el = expected_loss(pd_col, ead, lgd)
    r = df.rollup(decision_col).agg(F.count(el).alias("n_accounts"), F.sum(_c(ead)).alias("total_ead"),
                                    F.sum(el).alias("total_el"), F.avg(_c(pd_col)).alias("avg_pd"),
                                    F.grouping(decision_col).alias("_g"))
    total = r.where(F.col("_g") == 1).select(F.col("total_el").alias("_all"), F.lit(1).alias("_k"))
    groups = r.where(F.col("_g") == 0).drop("_g").withColumn("_k", F.lit(1))
    return groups.join(total, on="_k").select(
        decision_col, "n_accounts", "total_ead", "total_el", "avg_pd",
        (F.col("_all") - F.col("total_el")).alias("el_saved_vs_approve_all"))
