"""Weight-of-evidence encoder.

Fit = two scans for numeric features (see ``binning``) and one ``unpivot`` +
``groupBy`` for all categorical features. The fitted state is a *bins table*
``(feature, kind, bin_id, lower, upper, category, good, bad, woe)``.

Transform is a single projection: numeric features become a CASE over the edges
returning the WOE literal; categorical features become a literal map lookup
when the category count is small (known from the fit), else a join with the bins
table. No Python UDF anywhere.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from riskframe.functions.exprs import WOE_EPS
from riskframe.operators.binning import clean_double, numeric_bin_stats
from riskframe.session import persist

# Token for a missing category, default WOE of unseen values.
MISSING_TOKEN = "__MISSING__"
UNSEEN_WOE = 0.0
MAP_LOOKUP_MAX = 5000  # categories per feature inlined as a literal map; larger -> join

BINS_SCHEMA = ("feature string, kind string, bin_id int, lower double, upper double, category string, "
               "good long, bad long, woe double")


def _woe(g, b, G, B, eps=WOE_EPS):
    import math
    return math.log(((g + eps) / (G + eps)) / ((b + eps) / (B + eps)))


def _woe_col(g, b, G, B, eps=WOE_EPS):
    e = F.lit(eps)
    return F.log(((g + e) / (F.lit(float(G)) + e)) / ((b + e) / (F.lit(float(B)) + e)))


def category_key(c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TOKEN))


@dataclass
class WoeModel:
    bins: DataFrame                      # distributed bins table
    numeric_edges: dict[str, list[float]]
    numeric_woe: dict[str, list[float]]
    categorical: dict[str, int]          # feature -> number of categories
    global_good: int
    global_bad: int
    handle_unknown: str = "ignore"
    params: dict = field(default_factory=dict)
    _maps: dict[str, dict[str, float]] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.numeric_edges, *self.categorical]

    def get_woe_map(self, feature: str) -> DataFrame:
        return self.bins.where(F.col("feature") == feature)

    def _numeric_splits(self, c: str) -> list[float]:
        """Left-closed splits equal to the right-closed bins: (e_i, e_j] == [next_up(e_i), next_up(e_j))
        on doubles; e_0 itself opens bin 0 (lowest edge included); outer buckets are 'no bin'."""
        e = self.numeric_edges[c]
        up = [float(np.nextafter(v, np.inf)) for v in e[1:]]
        return [float("-inf"), float(e[0]), *up, float("inf")]

    def _numeric_expr(self, c: str, bucket_col: str | None) -> F.Column:
        """WOE from the bucket index: a literal array lookup (null outside the fitted range or NaN)."""
        woes = self.numeric_woe[c]
        if bucket_col is None:
            woe = F.lit(None).cast("double")
        else:
            lut = F.array(F.lit(None).cast("double"), *[F.lit(float(w)) for w in woes], F.lit(None).cast("double"))
            woe = F.try_element_at(lut, F.col(bucket_col).cast("int") + 1)
        return self._unknown(woe, c, F.col(c).cast("string"))

    def _unknown(self, woe: F.Column, c: str, shown: F.Column) -> F.Column:
        if self.handle_unknown == "error":
            return F.when(woe.isNull(), F.raise_error(F.concat(F.lit("Unseen value "), F.coalesce(shown, F.lit("nan")),
                                                               F.lit(f" of {c}")))).otherwise(woe)
        return F.coalesce(woe, F.lit(UNSEEN_WOE))

    def _category_map(self, c: str) -> dict[str, float]:
        if c not in self._maps:
            rows = self.bins.where(F.col("feature") == c).select("category", "woe").collect()  # <= MAP_LOOKUP_MAX
            self._maps[c] = {r["category"]: float(r["woe"]) for r in rows}
        return self._maps[c]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Replace each fitted feature present in ``df`` by its WOE (or add ``<f><suffix>``)."""
        present = set(df.columns)
        exprs: dict[str, F.Column] = {}
        joins: list[str] = []
        out = df
        # All numeric features in ONE multi-column Bucketizer (binary search per value).
        num = [c for c in self.numeric_edges if c in present and len(self.numeric_edges[c]) >= 2]
        if num:
            out = out.select("*", *[F.col(c).cast("double").alias(f"__wx_{c}") for c in num])
            out = Bucketizer(splitsArray=[self._numeric_splits(c) for c in num], inputCols=[f"__wx_{c}" for c in num],
                             outputCols=[f"__wb_{c}" for c in num], handleInvalid="keep").transform(out)
        for c in self.numeric_edges:
            if c in present:
                exprs[c] = self._numeric_expr(c, f"__wb_{c}" if c in num else None)
        for c, ncat in self.categorical.items():
            if c not in present:
                continue
            if ncat <= MAP_LOOKUP_MAX:
                m = self._category_map(c)
                if m:
                    lut = F.create_map(*[F.lit(x) for kv in sorted(m.items()) for x in kv])
                    w = F.try_element_at(lut, category_key(c))
                else:
                    w = F.lit(None).cast("double")
                exprs[c] = self._unknown(w, c, F.col(c).cast("string"))
            else:
                joins.append(c)
        for c in joins:  # high-cardinality: shuffle (or AQE broadcast) join on the category key
            lut = self.bins.where(F.col("feature") == c).select(F.col("category").alias(f"__k_{c}"),
                                                                F.col("woe").alias(f"__w_{c}"))
            out = out.withColumn(f"__k_{c}", category_key(c)).join(lut, on=f"__k_{c}", how="left")
            exprs[c] = self._unknown(F.col(f"__w_{c}"), c, F.col(c).cast("string"))
        cols = []
        for c in df.columns:
            if c in exprs and not suffix:
                cols.append(exprs[c].alias(c))
            else:
                cols.append(F.col(c))
        if suffix:
            cols += [exprs[c].alias(f"{c}{suffix}") for c in exprs]
        return out.select(*cols)

    # The encoder is its bins table plus a one-line JSON of parameters.
    def save(self, path: str) -> None:
        self.bins.write.mode("overwrite").parquet(f"{path}/bins")
        meta = {"global_good": self.global_good, "global_bad": self.global_bad,
                "handle_unknown": self.handle_unknown, "params": self.params,
                "numeric": list(self.numeric_edges), "categorical": self.categorical}
        spark = self.bins.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> WoeModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        bins = spark.read.parquet(f"{path}/bins")
        num_rows = bins.where(F.col("kind") == "numeric").orderBy("feature", "bin_id").collect()
        edges: dict[str, list[float]] = {c: [] for c in meta["numeric"]}
        woes: dict[str, list[float]] = {c: [] for c in meta["numeric"]}
        for r in num_rows:
            if not edges[r["feature"]]:
                edges[r["feature"]].append(r["lower"])
            edges[r["feature"]].append(r["upper"])
            woes[r["feature"]].append(r["woe"])
        return cls(bins, edges, woes, dict(meta["categorical"]), meta["global_good"], meta["global_bad"],
                   meta["handle_unknown"], meta["params"])


@dataclass
class WoeEncoder:
    n_bins: int = 10
    min_bin_size: float = 0.05
    handle_unknown: str = "ignore"
    method: str = "quantile"
    approx: bool = False

    def fit(self, df: DataFrame, features: Sequence[str] | None, target: str) -> WoeModel:
        spark = df.sparkSession
        features = [c for c in (features or [c for c in df.columns if c != target]) if c in df.columns]
        types = {f.name: f.dataType for f in df.schema.fields}
        numeric = [c for c in features if isinstance(types[c], (NumericType, BooleanType))]
        categorical = [c for c in features if c not in numeric]

        if not features:
            raise ValueError("no features to encode")
        nbins, n, G, B = numeric_bin_stats(df, numeric, target, self.n_bins, self.min_bin_size, self.method, self.approx)
        if G == 0 or B == 0:
            raise ValueError("Target must contain both classes (0 and 1)")

        rows = []
        edges, woes = {}, {}
        for nb in nbins:
            edges[nb.feature] = nb.edges
            woes[nb.feature] = [_woe(g, b, G, B) for g, b in zip(nb.good, nb.bad)]
            for i, (g, b, w) in enumerate(zip(nb.good, nb.bad, woes[nb.feature])):
                rows.append((nb.feature, "numeric", i, float(nb.edges[i]), float(nb.edges[i + 1]), None, g, b, w))
        num_df = spark.createDataFrame(rows, BINS_SCHEMA)

        cat_counts: dict[str, int] = {}
        bins = num_df
        if categorical:
            keys = F.array(*[F.struct(F.lit(c).alias("feature"), category_key(c).alias("category")) for c in categorical])
            cat = persist(df.select(F.col(target).alias("__y"), F.inline(keys)).groupBy("feature", "category").agg(
                F.count_if(F.col("__y") == 0).alias("good"), F.count_if(F.col("__y") == 1).alias("bad")))
            cat_counts = {c: 0 for c in categorical} | {
                r["feature"]: int(r["count"]) for r in cat.groupBy("feature").count().collect()}
            cat_bins = cat.select(
                "feature", F.lit("categorical").alias("kind"),
                F.lit(None).cast("int").alias("bin_id"),
                F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
                "category", F.col("good").cast("long").alias("good"), F.col("bad").cast("long").alias("bad"),
                _woe_col(F.col("good"), F.col("bad"), G, B).alias("woe"),
            )
            bins = num_df.unionByName(cat_bins)  # stays lazy on the cached category counts
        params = {"n_bins": self.n_bins, "min_bin_size": self.min_bin_size, "method": self.method}
        return WoeModel(bins, edges, woes, cat_counts, int(G), int(B), self.handle_unknown, params)

    def fit_transform(self, df: DataFrame, features: Sequence[str] | None, target: str) -> tuple[WoeModel, DataFrame]:
        m = self.fit(df, features, target)
        return m, m.transform(df)


def fit_woe_encoder(df: DataFrame, target: str, features: Sequence[str] | None = None, n_bins: int = 10,
                    min_bin_size: float = 0.05) -> WoeModel:
    """E10 convenience: default features = every column but the target."""
    return WoeEncoder(n_bins=n_bins, min_bin_size=min_bin_size).fit(df, features, target)
