"""Property-based invariants (few examples: each one is a handful of Spark jobs)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.operators.drift import calculate_psi
from riskframe.operators.selection import calculate_iv
from riskframe.operators.woe import WoeEncoder

rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5).map(float)), st.integers(0, 1)),
                min_size=20, max_size=80).filter(lambda r: {y for _, y in r} == {0, 1})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_bins_partition_and_iv_nonnegative(spark, data):
    pdf = pd.DataFrame(data, columns=["x", "target"])
    df = spark.createDataFrame(pdf, "x double, target int")
    m = WoeEncoder(n_bins=5, min_bin_size=0.1).fit(df, ["x"], "target")
    b = m.bins.where(F.col("feature") == "x").collect()
    n_binned = sum(r["good"] + r["bad"] for r in b)
    assert n_binned == int(pdf["x"].notna().sum())  # every non-missing value in exactly one bin
    enc = m.transform(df)
    iv = calculate_iv(enc, "target", ["x"]).first()["iv"]
    assert iv >= -1e-12


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.floats(-100, 100, allow_nan=False), min_size=5, max_size=60))
def test_psi_of_a_sample_with_itself_is_zero(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert abs(calculate_psi(df, df, "x").first()["psi"]) < 1e-12
