"""Attribution invariants and the example/rank tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators.attribution import (
    global_importance, hash_sample, linear_attribution, pick_diverse_examples, pick_spread_examples, rank_comparison, sampled_shapley,
)
from riskframe.plans.scoring import top_drivers


def _frame(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n), "c": rng.normal(size=n)})
    return spark.createDataFrame(pdf), pdf


def test_linear_attribution_sums_to_centred_margin(spark):
    df, pdf = _frame(spark)
    coef = [0.5, -2.0, 1.5]
    attr = linear_attribution(df, ["a", "b", "c"], coef, ["id"])
    s = {r["id"]: r["s"] for r in attr.groupBy("id").agg(F.sum("attribution").alias("s")).collect()}
    margin = pdf[["a", "b", "c"]].to_numpy() @ np.array(coef)
    centred = margin - margin.mean()
    for i in range(len(pdf)):
        assert s[i] == pytest.approx(centred[i], abs=1e-9)
    top = global_importance(attr).first()["feature"]
    assert top == "b"


def test_sampled_shapley_efficiency_and_linear_case(spark):
    df, pdf = _frame(spark, 200, 1)
    w = {"a": 1.0, "b": -0.5, "c": 2.0}

    def scorer(z):
        return z.withColumn("pd", F.col("a") * w["a"] + F.col("b") * w["b"] + F.col("c") * w["c"])

    rows = hash_sample(df, ["id"], 10)
    bg = hash_sample(df, ["id"], 1, seed=3)  # one background row: Shapley of a linear model is exact
    res = sampled_shapley(rows, bg, ["a", "b", "c"], ["id"], scorer, n_permutations=4)
    bgrow = bg.first()
    got = res.collect()
    assert len(got) == 30
    for r in got:
        x = pdf.loc[pdf.id == r["id"]].iloc[0]
        assert r["attribution"] == pytest.approx(w[r["feature"]] * (x[r["feature"]] - bgrow[r["feature"]]), abs=1e-9)
    sums = res.groupBy("id").agg(F.sum("attribution").alias("s"), F.first("f_x").alias("fx"),
                                 F.first("f_background").alias("f0")).collect()
    for r in sums:
        assert r["s"] == pytest.approx(r["fx"] - r["f0"], abs=1e-9)


def test_pick_diverse_examples(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(11)], "id int, s double")
    ex = {r["example"]: sorted(x["id"] for x in pick_diverse_examples(df, "s", ["id"], 6).collect() if x["example"] == r["example"])
          for r in pick_diverse_examples(df, "s", ["id"], 6).collect()}
    assert ex["low"] == [0, 1] and ex["high"] == [9, 10] and ex["median"] == [4, 5]


def test_rank_comparison_full_outer(spark):
    imp = spark.createDataFrame([("a", 0.9), ("b", 0.5), ("c", 0.1)], "feature string, mean_abs_attribution double")
    res = {r["feature"]: r for r in rank_comparison(imp, {"a": 0.1, "b": -3.0, "d": 1.0}, top_k=2).collect()}
    assert set(res) == {"a", "b", "d"}
    assert res["a"]["shap_rank"] == 1 and res["a"]["logreg_rank"] is None
    assert res["b"]["rank_diff"] == 1


def test_top_drivers_order(spark):
    df = spark.createDataFrame([(1, 0.1, -0.9, 0.5)], "id int, f1 double, f2 double, f3 double")
    rows = top_drivers(df, ["f1", "f2", "f3"], ["id"], k=2).orderBy("rank").collect()
    assert [r["feature"] for r in rows] == ["f2", "f3"]


def test_background_is_numbered_over_ranges(spark):
    df, _ = _frame(spark, 300, 3)
    few = sampled_shapley(df, df, ["a", "b", "c"], ["id"], lambda z: z.withColumn("pd", F.col("a")), range_rows=10)
    one = sampled_shapley(df, df, ["a", "b", "c"], ["id"], lambda z: z.withColumn("pd", F.col("a")))
    key = lambda d: sorted((r["id"], r["feature"], round(r["attribution"], 9)) for r in d.collect())
    assert key(few) == key(one)


def test_hash_sample_population_cut_gives_same_rows(spark):
    df, _ = _frame(spark, 3000, 5)
    full = sorted(r["id"] for r in hash_sample(df, ["id"], 25).collect())
    cut = sorted(r["id"] for r in hash_sample(df, ["id"], 25, population=3000).collect())
    assert full == cut and len(full) == 25


def test_shapley_query_explains_every_row_of_the_view(spark):
    from riskframe.plans.q_models import MODEL_FEATURES, _encoded
    from riskframe.plans.q_reports import LOAN_KEY, q_sampled_shapley
    sf = "/root/testdata/sf0.001"
    got, want = q_sampled_shapley(spark, sf).groupBy(*LOAN_KEY).count(), _encoded(spark, sf).groupBy(*LOAN_KEY).count()
    assert {tuple(r)[:-1]: r["count"] for r in got.collect()} == {tuple(r)[:-1]: r["count"] * len(MODEL_FEATURES) for r in want.collect()}


def test_shapley_rows_that_repeat_their_keys(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 5.0), (2, 3.0)], "id int, a double")
    bg = spark.createDataFrame([(0.0,)], "a double")
    got = sampled_shapley(df, bg, ["a"], ["id"], lambda z: z.withColumn("pd", F.col("a")))
    assert sorted((r.id, r.attribution) for r in got.collect()) == [(1, 1.0), (1, 5.0), (2, 3.0)]


def test_spread_examples_at_even_ranks(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": np.arange(500), "a": rng.integers(-2, 3, 500).astype(float), "b": rng.integers(-1, 2, 500).astype(float)})
    pdf.loc[:199, ["a", "b"]] = 1.0                     # one mean holds 40 % of the rows
    long = pdf.melt("id", var_name="feature", value_name="attribution")
    attr = spark.createDataFrame(long.sample(frac=1, random_state=1)).repartition(7)
    order = (pdf.set_index("id").abs().mean(axis=1).reset_index(name="m").sort_values(["m", "id"], ignore_index=True))
    for n in (1, 3, 7):
        got = {r["example"]: r for r in pick_spread_examples(attr, ["id"], n).collect()}
        step = len(pdf) // n
        assert sorted(got) == list(range(n))
        for i in range(n):
            k = min(i * step + step // 2, len(pdf) - 1)
            assert got[i]["example_rank"] == k and got[i]["id"] == order.id[k]
            assert got[i]["mean_abs_attribution"] == pytest.approx(order.m[k])
    few = pick_spread_examples(attr.where("id < 2"), ["id"], 3).collect()
    assert [(r["id"], r["example_rank"]) for r in few] == [(0, 0)] * 3
    assert pick_spread_examples(attr.limit(0), ["id"], 3).collect() == []
    with pytest.raises(ValueError):
        pick_spread_examples(attr, ["id"], 0)


def test_shapley_hash_is_that_of_the_engine(spark):
    from riskframe.operators.attribution import _hash_int
    draws = [(0, 0), (3, 42), (7, -5), (-2**31, 2**31 - 1)]
    got = spark.range(500).select(F.xxhash64("id", F.col("id").cast("string")).alias("key"), *[
        F.xxhash64("id", F.col("id").cast("string"), F.lit(t), F.lit(i)).alias(f"h{n}") for n, (t, i) in enumerate(draws)]).toPandas()
    for n, (t, i) in enumerate(draws):
        assert (_hash_int(i, _hash_int(t, got.key.to_numpy().view(np.uint64))).view(np.int64) == got[f"h{n}"]).all()


def test_shapley_steps_are_compiled(spark):
    """The machine code compiler leaves methods of more than 8,000 bytes to the interpreter, some fifty times slower."""
    import re
    df = spark.range(100).select("id", *[(F.col("id") % n).cast("double").alias(c) for c, n in (("a", 3), ("b", 4), ("c", 5))])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = sampled_shapley(df, df.limit(5), ["a", "b", "c"], ["id"], lambda z: z.withColumn("pd", F.col("a") * F.col("b")))
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", got._jdf.queryExecution().explainString(mode))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000


def test_shapley_of_missing_scores_no_rows_and_missing_features(spark, monkeypatch):
    from riskframe.operators import attribution
    df = spark.createDataFrame([(i, None if i % 5 == 0 else float(i % 3), float("nan") if i % 7 == 0 else i % 2 * 1.0)
                                for i in range(60)], "id int, a double, b double")
    bg = df.where("id in (1, 2, 4)")
    filled = lambda c, v: F.when(F.col(c).isNull() | F.isnan(c), F.lit(v)).otherwise(F.col(c))
    scorers = [lambda z: z.withColumn("pd", filled("a", 0.5) * filled("b", 7.0)),
               lambda z: z.withColumn("pd", F.when(F.col("a") != 2, filled("b", 7.0)))]
    run = lambda d, f: sorted(map(str, sampled_shapley(d, bg, ["a", "b"], ["id"], f, n_permutations=4).collect()))
    assert run(df.where("id < 0"), scorers[0]) == []
    got = [run(df, f) for f in scorers]
    monkeypatch.setattr(attribution, "MIXTURES", 0)
    assert got == [run(df, f) for f in scorers] and len(got[0]) == 120
