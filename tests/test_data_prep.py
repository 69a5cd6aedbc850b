"""Splits, imputation and quality checks (facts of the reference tests and more)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskframe.operators.impute import fit_imputer, impute
from riskframe.operators.quality import (
    check_duplicates, check_for_leakage, check_schema, check_target_values, missing_rates, run_all_checks,
)
from riskframe.operators.split import stratified_split, time_based_split


def _daily(spark):
    start = dt.datetime(2023, 1, 1)
    return spark.createDataFrame([(start + dt.timedelta(days=i), i, i % 2) for i in range(100)],
                                 "date timestamp, feature int, target int")


def test_leakage_detected(spark):
    df = spark.createDataFrame([(1, 0, 100)], "feature int, target int, recovery_amount int")
    with pytest.raises(ValueError, match="Leakage"):
        check_for_leakage(df, ["recovery_amount"], strict=True)
    ok = spark.createDataFrame([(1, 0)], "feature int, target int")
    assert check_for_leakage(ok, ["recovery_amount"]).first()["passed"]


def test_time_split_bounds_and_empty_oot(spark):
    tr, te, oot = time_based_split(_daily(spark), "date", "2023-03-01", "2023-05-01")
    assert tr.agg(F.max("date")).first()[0] < dt.datetime(2023, 3, 1)
    assert te.agg(F.min("date")).first()[0] >= dt.datetime(2023, 3, 1)
    assert oot.count() == 0  # data ends 2023-04-10
    assert tr.count() + te.count() == 100


def test_time_split_sizes_and_errors(spark):
    tr, te, oot = time_based_split(_daily(spark), "date", "2023-02-01", "2023-03-15")
    assert (tr.count(), te.count(), oot.count()) == (31, 42, 27)
    with pytest.raises(ValueError, match="Train set is empty"):
        time_based_split(_daily(spark), "date", "2022-01-01")
    with pytest.raises(ValueError, match="Date column"):
        time_based_split(_daily(spark).drop("date"), "date", "2023-02-01")


def test_impute_median_mode(spark):
    df = spark.createDataFrame([(1.0, "a", 0), (None, "b", 1), (3.0, None, 0), (4.0, "b", 1), (2.0, "a", 0), (None, None, 1)],
                               "num double, cat string, target int")
    state = fit_imputer(df)
    assert state.numeric == {"num": 2.5}
    assert state.categorical == {"cat": "a"}  # tie a/b -> smallest
    out = impute(df, state)
    assert out.where(F.col("num").isNull() | F.col("cat").isNull()).count() == 0
    # a column without missing values at fit time is not filled later
    later = spark.createDataFrame([(None, None, None)], "num double, cat string, target int")
    assert impute(later, state).first()["target"] is None


def test_impute_all_missing_category(spark):
    df = spark.createDataFrame([(None,), (None,)], "cat string")
    assert fit_imputer(df).categorical == {"cat": "Unknown"}


def test_schema_missing_date_and_target_values(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "feature int, target int")
    r = check_schema(df, "target", "date").first()
    assert not r["passed"] and any("Date column" in i for i in r["issues"])
    t3 = spark.createDataFrame([(0,), (1,), (2,)], "target int")
    r = check_target_values(t3, "target").first()
    assert not r["passed"] and "unexpected values" in r["issues"][0]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 10), (1, 10), (2, 20), (3, 30)], "id int, feature int")
    r = check_duplicates(df).first()
    assert r["value"] == 1.0 and not r["passed"]
    assert check_duplicates(df, "id").first()["value"] == 1.0


def test_missing_rates_threshold_is_strict(spark):
    df = spark.createDataFrame([(None, 1), (1, 2)], "a int, b int")
    rates = {r["column_name"]: (r["missing_rate"], r["flagged"]) for r in missing_rates(df, 0.5).collect()}
    assert rates["a"] == (0.5, False) and rates["b"] == (0.0, False)


def test_run_all_checks_on_loans(spark):
    from riskframe.sources.tables import loans
    l = loans(spark, "/root/testdata/sf0.001")
    res = {r["check"]: r["passed"] for r in run_all_checks(l, "y", "l_shipdate", ["l_returnflag"], labelled=l).collect()}
    assert res["leakage"] is False and res["period_overlap"] is True and res["schema"] is True
    with pytest.raises(ValueError, match="leakage"):
        run_all_checks(l, "y", "l_shipdate", ["l_returnflag"], strict=True)


def test_stratified_split_share_per_class(spark):
    from riskframe.sources.tables import LOAN_KEY, loans
    l = stratified_split(loans(spark, "/root/testdata/sf0.01"), "y", LOAN_KEY, 0.2, seed=42)
    shares = {r["y"]: r["share"] for r in l.groupBy("y").agg(F.avg((F.col("part") == "test").cast("double")).alias("share")).collect()}
    for s in shares.values():
        assert abs(s - 0.2) < 0.01
    again = stratified_split(loans(spark, "/root/testdata/sf0.01"), "y", LOAN_KEY, 0.2, seed=42)
    assert l.where(F.col("part") == "test").count() == again.where(F.col("part") == "test").count()


def test_checks_on_empty_frame(spark):
    df = spark.createDataFrame([], "a double, target int, d timestamp")
    res = {r["check"]: r for r in run_all_checks(df, "target", "d").collect()}
    assert res["missingness"]["passed"] and not res["schema"]["passed"]


def test_approximate_duplicates_close_to_exact(spark):
    from riskframe.sources.tables import loans
    l = loans(spark, "/root/testdata/sf0.01")
    exact = check_duplicates(l, "l_orderkey").first()["value"]
    approx = check_duplicates(l, "l_orderkey", approx=True).first()["value"]
    assert abs(approx - exact) / exact < 0.03


def test_exact_stratified_split_counts(spark):
    from riskframe.sources.tables import LOAN_KEY, loans
    l = loans(spark, "/root/testdata/sf0.01")
    lab = stratified_split(l, "y", LOAN_KEY, 0.2, seed=7, exact=True)
    got = {(r["y"], r["part"]): r["n"] for r in lab.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {r["y"]: r["n"] for r in l.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    for cls, n in sizes.items():
        assert got[(cls, "test")] == round(0.2 * n)
        assert got[(cls, "test")] + got[(cls, "train")] == n
