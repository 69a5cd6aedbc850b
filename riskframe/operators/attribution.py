"""Attribution (X1-X6) as Spark jobs.

* linear attribution: coef_j * (x_j - mean_j) per row (exact interventional Shapley
  values of a linear margin with independent features), one aggregate for the means;
* sampled Shapley for any scorer: for each explained row and permutation, the chain
  z_0 (all background) ... z_p (all explained) differs in one feature per step;
  the model scores every z_k in ONE ``transform`` and the step differences, averaged
  over permutations, are the attributions. Rows and background are hash-sampled
  (the sample size is the operator's parameter), the background side is bounded by
  that size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.curves import prefix_below
from riskframe.operators.split import hash_fraction
from riskframe.session import persist, reliable_checkpoint

BACKGROUND_RANGE = 5_000  # background rows that one window numbers, about
MIXTURES = 2_000_000  # mixed vectors up to which all are scored once, before the rows look their steps up

# Risk labels of the local example table.
LOW_RISK_PD = 0.1
HIGH_RISK_PD = 0.3


def linear_attribution(df: DataFrame, features: Sequence[str], coefficients: Sequence[float], keep: Sequence[str],
                       background: DataFrame | None = None) -> DataFrame:
    """Long table (keep..., feature, value, attribution) with attribution = coef * (x - mean_background)."""
    feats = list(features)
    bg = background if background is not None else df
    means = bg.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in feats]).first()
    cols = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                     (F.lit(float(b)) * (F.col(c).cast("double") - F.lit(float(means[c] or 0.0)))).alias("attribution"))
            for c, b in zip(feats, coefficients)]
    return df.select(*keep, F.inline(F.array(*cols)))


def hash_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42, population: int | None = None) -> DataFrame:
    """Deterministic sample of ``n`` rows: the n smallest key hashes (a top-k, no full sort).

    With ``population`` (a known or estimated row count) the rows are first cut at a hash of
    about 4n/population, so the top-k runs over ~4n rows instead of n per partition; if fewer
    than n rows pass the cut, the plain top-k is used. The result is the same either way."""
    h = df.withColumn("__h", hash_fraction(keys, seed))
    if population and 4 * n < population:
        cand = h.where(F.col("__h") < F.lit(4.0 * n / population))
        if cand.count() >= n:  # the n smallest hashes all lie below the cut
            return cand.orderBy("__h").limit(n).drop("__h")
    return h.orderBy("__h").limit(n).drop("__h")


def _numbered(rows: DataFrame, features: Sequence[str], seed: int, ranges: int) -> DataFrame:
    """``rows`` with ``__b`` = 0, 1, ... in the order of their hash: numbered within hash ranges, after the
    range's offset (one row per range is brought together)."""
    h = rows.withColumn("__h", hash_fraction(features, seed))
    h = h.withColumn("__range", F.least(F.floor(F.col("__h") * ranges), F.lit(ranges - 1)))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = h.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    number = F.row_number().over(Window.partitionBy("__range").orderBy("__h")) - 1
    return h.withColumn("__i", number).join(offsets, "__range").withColumn(
        "__b", F.col("__offset") + F.col("__i")).drop("__h", "__range", "__i", "__offset")


def sampled_shapley(rows: DataFrame, background: DataFrame, features: Sequence[str], keys: Sequence[str],
                    scorer: Callable[[DataFrame], DataFrame], score_col: str = "pd", n_permutations: int = 8,
                    seed: int = 42, range_rows: int = BACKGROUND_RANGE) -> DataFrame:
    """Permutation-sampled Shapley values of ``scorer`` (a DataFrame -> DataFrame adding ``score_col``).

    Output long table (keys..., feature, attribution, f_x, f_background). For every
    (row, permutation) the attributions sum exactly to f(x) - f(background row used). Rows that repeat their keys
    are explained one by one."""
    feats = list(features)
    p = len(feats)
    background = reliable_checkpoint(background.select(*feats))
    n_bg = background.count()
    if n_bg == 0:
        raise ValueError("empty background")
    bg = _numbered(background, feats, seed, max(1, n_bg // range_rows))
    most = MIXTURES // (n_bg << p)
    if most and -2**31 <= seed < 2**31:
        vectors = reliable_checkpoint(rows.select(*feats).distinct().limit(most + 1))
        if vectors.count() <= most:
            found = _looked_up(rows, vectors, bg, n_bg, feats, keys, scorer, score_col, n_permutations, seed)
            if found is not None:
                return found
    perms = F.sequence(F.lit(0), F.lit(n_permutations - 1))
    ids = [*keys, "__rep"]
    rows = rows.withColumn("__rep", F.row_number().over(Window.partitionBy(*keys).orderBy(*feats)))
    ex = (rows.select(*ids, *[F.col(c).alias(f"__x_{c}") for c in feats])
          .withColumn("__perm", F.explode(perms))
          .withColumn("__bidx", F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.col("__perm"), F.lit(seed)), F.lit(n_bg))))
    # Random order of the features per (row, permutation): rank of a per-feature hash.
    order = F.array(*[F.struct(F.xxhash64(*[F.col(k) for k in keys], F.col("__perm"), F.lit(i), F.lit(seed)).alias("h"),
                               F.lit(i).alias("i")) for i in range(p)])
    ex = ex.withColumn("__order", F.transform(F.array_sort(order), lambda s: s["i"]))
    joined = ex.join(bg, ex["__bidx"] == bg["__b"], "inner")
    chain = joined.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(p))))
    # Feature i comes from x when its position in the permutation is < k.
    hybrid = [F.when(F.array_position(F.col("__order"), F.lit(i)) - 1 < F.col("__k"), F.col(f"__x_{c}"))
              .otherwise(F.col(c)).alias(c) for i, c in enumerate(feats)]
    z = chain.select(*ids, "__perm", "__k", "__order", *hybrid)
    scored = scorer(z)
    w = Window.partitionBy(*ids, "__perm").orderBy("__k")
    steps = scored.select(*ids, "__perm", "__k", "__order",
                          (F.col(score_col) - F.lag(score_col).over(w)).alias("__d"),
                          F.first(score_col).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__f0"),
                          F.last(score_col).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__fx"))
    feat_names = F.array(*[F.lit(c) for c in feats])
    contrib = (steps.where(F.col("__k") > 0)
               .withColumn("feature", F.element_at(feat_names, F.element_at(F.col("__order"), F.col("__k")) + 1)))
    return (contrib.groupBy(*ids, "feature")
            .agg(F.avg("__d").alias("attribution"), F.avg("__fx").alias("f_x"), F.avg("__f0").alias("f_background")).drop("__rep"))


def _looked_up(rows: DataFrame, vectors: DataFrame, bg: DataFrame, n_bg: int, feats: list[str], keys: Sequence[str],
               scorer: Callable[[DataFrame], DataFrame], score_col: str, n_permutations: int, seed: int) -> DataFrame | None:
    """``sampled_shapley`` where the rows have few different vectors: every mixture of a vector and a background row is
    scored once (bit i of its mask: feature i is the vector's), and a row looks up the two ends of each of its steps.
    The same chains and scores, without a shuffle of the rows. The scores (up to MIXTURES) go to every Python worker; a row
    sends the hash of its keys and the number of its vector there."""
    p = len(feats)
    of = [f"__of_{i}" for i in range(p)]
    number = F.row_number().over(Window.orderBy(*of)) - 1  # of at most MIXTURES vectors
    vectors = reliable_checkpoint(vectors.select(*[F.col(c).alias(o) for c, o in zip(feats, of)]).withColumn("__v", number))
    mixed = vectors.crossJoin(bg).withColumn("__mask", F.explode(F.sequence(F.lit(0), F.lit((1 << p) - 1))))
    hybrid = [F.when(F.col("__mask").bitwiseAND(F.lit(1 << i)) != 0, F.col(o)).otherwise(F.col(c)).alias(c)
              for i, (c, o) in enumerate(zip(feats, of))]
    at = ((F.col("__v") * F.lit(n_bg) + F.col("__b")) * F.lit(1 << p) + F.col("__mask")).cast("long").alias("__at")
    mixed = mixed.repartition("__v").select(at, *hybrid)
    table = scorer(mixed).select("__at", F.col(score_col).cast("double").alias("f")).toArrow()  # up to MIXTURES numbers
    if table["f"].null_count or table.num_rows != vectors.count() * n_bg << p:
        return None  # steps without a score do not count, which sums do not tell
    scores = np.empty(table.num_rows)
    scores[table["__at"].to_numpy()] = table["f"].to_numpy()
    means = F.arrow_udf(_means(scores, n_bg, p, n_permutations, seed), "array<double>")

    found = rows.join(F.broadcast(vectors), [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(feats, of)])
    key = F.xxhash64(*keys) if keys else F.lit(42).cast("long")
    found = found.select(*keys, key.alias("__key"), "__v").select(*keys, means("__key", "__v").alias("__s"))
    steps = F.array(*[F.struct(F.lit(c).alias("feature"), F.get("__s", F.lit(i)).alias("attribution")) for i, c in enumerate(feats)])
    found = found.select(*keys, steps.alias("__steps"), F.get("__s", F.lit(p)).alias("f_x"), F.get("__s", F.lit(p + 1)).alias("f_background"))
    return found.select(*keys, F.inline("__steps"), "f_x", "f_background")


def _hash_int(value: int, key: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int after the columns whose hash is ``key`` (unsigned, as the result)."""
    u = np.uint64
    h = key + u(0x27D4EB2F165667C5 + 4)
    h ^= u((value & 0xFFFFFFFF) * 0x9E3779B185EBCA87 & (1 << 64) - 1)
    h = ((h << u(23)) | (h >> u(41))) * u(0xC2B2AE3D27D4EB4F) + u(0x165667B19E3779F9)
    h ^= h >> u(33)
    h *= u(0xC2B2AE3D27D4EB4F)
    h ^= h >> u(29)
    h *= u(0x165667B19E3779F9)
    h ^= h >> u(32)
    return h


def _means(scores: np.ndarray, n_bg: int, p: int, n_permutations: int, seed: int):
    """From hash of the keys and number of the vector to the means over permutations of the features' steps, f(x) and
    f(background), drawn as ``sampled_shapley`` draws them."""
    def run(key: pa.Array, vector: pa.Array) -> pa.Array:
        hashed = key.to_numpy().view(np.uint64)
        first = vector.to_numpy().astype(np.int64) * (n_bg << p)
        sums = np.zeros((len(hashed), p + 2))
        for t in range(n_permutations):
            by_perm = _hash_int(t, hashed)
            at = first + (_hash_int(seed, by_perm).view(np.int64) % n_bg << p)
            order = [_hash_int(seed, _hash_int(i, by_perm)).view(np.int64) for i in range(p)]
            before = [np.zeros(len(at), np.int64) for _ in range(p)]  # mask of the features that come before each
            for i in range(p):
                for j in range(i):
                    later = order[j] > order[i]
                    before[j] += later.astype(np.int64) << i
                    before[i] += (~later).astype(np.int64) << j
            for i in range(p):
                start = at + before[i]
                sums[:, i] += scores[start + (1 << i)] - scores[start]
            sums[:, p] += scores[at + ((1 << p) - 1)]
            sums[:, p + 1] += scores[at]
        sums /= n_permutations
        return pa.ListArray.from_arrays(np.arange(0, sums.size + 1, p + 2, dtype=np.int32), sums.ravel())
    return run


def global_importance(attr: DataFrame, top: int | None = None) -> DataFrame:
    """Mean |attribution| per feature, descending (top ``top`` if given)."""
    g = attr.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))
    g = g.orderBy(F.col("mean_abs_attribution").desc(), "feature")
    return g.limit(top) if top else g


def pick_diverse_examples(df: DataFrame, score: str, keys: Sequence[str], n: int = 3) -> DataFrame:
    """n//3 lowest scores, n//3 highest, the rest closest to the exact median (ties by key).
    Three bounded top-k selections; with n < 3 only the median picks remain."""
    n_low = n_high = n // 3
    n_mid = n - n_low - n_high
    key_order = [F.col(k).asc() for k in keys]
    parts = []
    if n_low:
        parts.append(df.orderBy(F.col(score).asc(), *key_order).limit(n_low).withColumn("example", F.lit("low")))
        parts.append(df.orderBy(F.col(score).desc(), *key_order).limit(n_high).withColumn("example", F.lit("high")))
    if n_mid:
        from riskframe.operators.binning import exact_quantiles
        med = exact_quantiles(df, {score: F.col(score)}, [0.5])[score][0]
        mid = (df.orderBy(F.abs(F.col(score) - F.lit(med)).asc(), *key_order).limit(n_mid)
               .withColumn("example", F.lit("median")))
        parts.append(mid)
    outp = parts[0]
    for x in parts[1:]:
        outp = outp.unionByName(x)
    return outp


def pick_spread_examples(attr: DataFrame, keys: Sequence[str], n: int = 3) -> DataFrame:
    """X3 without scores: rows at ``n`` evenly spaced ranks of mean |attribution| over a long table, smallest first.

    With N rows and step N // n the 0-based ranks are i * step + step // 2, at most N - 1 (so with fewer than ``n`` rows
    the first comes n times, as example 0 to n - 1). Equal means are ordered by key, rows without any attribution are left
    out, an empty table gives none. Ranks are found through the counts below each distinct mean, so neither a sort in one
    task nor a hot mean matters: only the rows with a wanted mean are numbered, within key ranges.
    Columns: keys, mean_abs_attribution, example (0 to n - 1), example_rank."""
    if n < 1:
        raise ValueError("n must be at least 1")
    size = persist(attr.groupBy(*keys).agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))
                   .where(F.col("mean_abs_attribution").isNotNull()))
    total = size.count()
    step = total // n
    wanted = [(i, min(i * step + step // 2, total - 1)) for i in range(n)] if total else []
    ranks = size.sparkSession.createDataFrame(wanted, "example int, example_rank long")
    collapsed = size.groupBy("mean_abs_attribution").agg(F.count(F.lit(1)).cast("double").alias("c"))
    below = prefix_below(collapsed, "mean_abs_attribution", cols=["c"])
    hit = below.join(F.broadcast(ranks), (F.col("example_rank") >= F.col("c_below")) &  # n rows
                     (F.col("example_rank") < F.col("c_below") + F.col("c")))
    hit = hit.select("mean_abs_attribution", "example", "example_rank",
                     (F.col("example_rank") - F.col("c_below")).cast("long").alias("__at"))
    # Rows that share a wanted mean: cut into key ranges first, so that a mean held by a third of all rows is not one group.
    tied = size.join(F.broadcast(hit.select("mean_abs_attribution").distinct()), "mean_abs_attribution")
    key = [F.col(k) for k in keys]
    parts = max(1, int(size.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    tied = persist(tied.repartitionByRange(parts, "mean_abs_attribution", *key).withColumn("__part", F.spark_partition_id()))
    before = Window.partitionBy("mean_abs_attribution").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tied.groupBy("mean_abs_attribution", "__part").agg(F.count(F.lit(1)).alias("__n")).select(
        "mean_abs_attribution", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy("mean_abs_attribution", "__part").orderBy(*key)) - 1
    numbered = tied.withColumn("__i", inside).join(offsets, ["mean_abs_attribution", "__part"]).withColumn(
        "__at", F.col("__i") + F.col("__offset"))
    return numbered.join(F.broadcast(hit), ["mean_abs_attribution", "__at"]).select(
        *keys, "mean_abs_attribution", "example", "example_rank")


def risk_label(score: str) -> F.Column:
    """X4 label: pd < 0.1 low_risk, pd > 0.3 high_risk, else borderline."""
    s = F.col(score)
    return F.when(s < LOW_RISK_PD, "low_risk").when(s > HIGH_RISK_PD, "high_risk").otherwise("borderline")


def local_examples(attr: DataFrame, examples: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Attribution rows of the picked examples with their risk label."""
    ex = examples.select(*keys, score, "example", risk_label(score).alias("risk_label"))
    return attr.join(ex, on=list(keys), how="inner")


def rank_comparison(attr_importance: DataFrame, coefficients: dict[str, float], top_k: int = 10) -> DataFrame:
    """Top-k by mean |attribution| vs top-k by |coefficient|, full outer join on feature,
    ranks by value (the reference's alphabetical rank is a defect) and |rank difference|."""
    spark = attr_importance.sparkSession
    a = attr_importance.orderBy(F.col("mean_abs_attribution").desc(), "feature").limit(top_k)
    c = spark.createDataFrame([(f, abs(float(v))) for f, v in coefficients.items()], "feature string, abs_coef double")
    c = c.orderBy(F.col("abs_coef").desc(), "feature").limit(top_k)
    m = a.join(c, on="feature", how="full_outer")
    w1 = Window.orderBy(F.col("mean_abs_attribution").desc_nulls_last(), "feature")  # <= 2k rows
    w2 = Window.orderBy(F.col("abs_coef").desc_nulls_last(), "feature")
    m = (m.withColumn("shap_rank", F.when(F.col("mean_abs_attribution").isNotNull(), F.rank().over(w1)))
         .withColumn("logreg_rank", F.when(F.col("abs_coef").isNotNull(), F.rank().over(w2))))
    return m.withColumn("rank_diff", F.abs(F.col("shap_rank") - F.col("logreg_rank")))


def dependence_data(attr: DataFrame) -> DataFrame:
    """(feature, value, attribution) pairs behind dependence plots."""
    return attr.select("feature", "value", "attribution")
