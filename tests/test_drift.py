"""PSI: numpy statement of the bucketing, invariants, report, by-period and streaming parity."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators.drift import calculate_psi, psi_buckets, psi_by_period, psi_report, variable_psi


def _np_psi(e, a, buckets=10):
    e, a = e[~np.isnan(e)], a[~np.isnan(a)]
    edges = np.unique(np.quantile(e, np.linspace(0, 1, buckets + 1)))
    k = len(edges) - 1
    eb = np.clip(np.digitize(e, edges) - 1, 0, k - 1)
    ab = np.clip(np.digitize(a, edges) - 1, 0, k - 1)
    ec, ac = np.bincount(eb, minlength=k), np.bincount(ab, minlength=k)
    ep, ap = np.maximum(ec / len(e), 1e-10), np.maximum(ac / len(a), 1e-10)
    return float(np.sum((ap - ep) * np.log(ap / ep))), ec, ac


def test_psi_matches_numpy(spark):
    rng = np.random.default_rng(0)
    e = np.round(rng.normal(size=2000), 2)
    a = np.round(rng.normal(0.3, 1.2, size=1500), 2)
    a[:10] = np.nan
    ed = spark.createDataFrame(pd.DataFrame({"x": e}))
    ad = spark.createDataFrame(pd.DataFrame({"x": a}))
    psi, ec, ac = _np_psi(e, a)
    rows = psi_buckets(ed, ad, "x").orderBy("bucket").collect()
    assert [r["expected_count"] for r in rows] == list(ec)
    assert [r["actual_count"] for r in rows] == list(ac)
    assert calculate_psi(ed, ad, "x").first()["psi"] == pytest.approx(psi, abs=1e-12)


def test_psi_of_identical_is_zero_and_labels(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": np.arange(1000.0)}))
    r = calculate_psi(df, df, "x").first()
    assert r["psi"] == pytest.approx(0.0, abs=1e-15) and r["interpretation"] == "stable"


def test_constant_reference_gives_zero(spark):
    e = spark.createDataFrame([(1.0,)] * 20, "x double")
    a = spark.createDataFrame([(2.0,)] * 20, "x double")
    assert calculate_psi(e, a, "x").first()["psi"] == 0.0


def test_variable_psi_matches_single(spark):
    from riskframe.sources.tables import loans
    l = loans(spark, "/root/testdata/sf0.001")
    tr, oot = l.where(F.col("split") == "train"), l.where(F.col("split") == "oot")
    multi = {r["variable"]: r["psi"] for r in variable_psi(tr, oot, ["l_quantity", "l_tax", "p"]).collect()}
    for c in ["l_quantity", "l_tax", "p"]:
        assert multi[c] == pytest.approx(calculate_psi(tr, oot, c).first()["psi"], abs=1e-12)


def test_report_matches_single_comparisons(spark):
    from riskframe.sources.tables import loans
    l = loans(spark, "/root/testdata/sf0.001")
    rep = {r["comparison"]: r["psi"] for r in
           psi_report(l, "p").groupBy("comparison").agg(F.sum("psi_contribution").alias("psi")).collect()}
    parts = {s: l.where(F.col("split") == s) for s in ("train", "test", "oot")}
    assert rep["score_psi_oot_vs_test"] == pytest.approx(calculate_psi(parts["test"], parts["oot"], "p").first()["psi"], abs=1e-12)
    assert rep["score_psi_test_vs_train"] == pytest.approx(calculate_psi(parts["train"], parts["test"], "p").first()["psi"], abs=1e-12)


def test_streaming_matches_batch_on_closed_windows(spark):
    from riskframe.plans.q_stream import q_psi_stream
    sf = "/root/testdata/sf0.001"
    stream = {r["window_start"]: r["psi"] for r in q_psi_stream(spark, sf).collect()}
    ev = spark.read.parquet(f"{sf}/events.parquet")
    batch = {r["window_start"]: r["psi"] for r in psi_by_period(ev, "value", "ts", "2024-01-08", "1 day").collect()}
    assert stream, "no closed window"
    last = max(batch)
    assert last not in stream  # the newest window is still open under the watermark
    for w, v in stream.items():
        assert v == pytest.approx(batch[w], abs=1e-6)
    assert len(stream) >= len(batch) - 2


def test_empty_actual_side_gives_nan(spark):
    e = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    a = spark.createDataFrame([], "x double")
    r = calculate_psi(e, a, "x").first()
    assert r["psi"] != r["psi"]  # NaN, as for an empty side in the reference


def test_detailed_psi_of_a_constant_reference_is_zero(spark):
    from riskframe.operators.drift import calculate_psi_detailed
    ref = spark.createDataFrame([(1.0,)] * 5 + [(None,)], "x double")
    act = spark.createDataFrame([(2.0,), (3.0,), (float("nan"),)], "x double")
    summary, detail = calculate_psi_detailed(ref, act, "x")
    r = summary.first()
    assert (r["psi"], r["interpretation"], r["n_expected"], r["n_actual"]) == (0.0, "stable", 5, 2) and detail.isEmpty()
    assert calculate_psi_detailed(ref, act.limit(0), "x")[0].first()["psi"] != 0.0  # nothing to compare: not a number


def test_report_with_variable_section_and_own_limits(spark):
    import numpy as np
    import pandas as pd

    from riskframe.config import RiskConfig
    from riskframe.operators.drift import calculate_psi, drift_report, variable_psi
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"split": np.repeat(["train", "test", "oot"], 200), "s": rng.random(600), "v": rng.normal(size=600),
                        "one": 1.0, "word": "w"})
    pdf.loc[pdf.split == "oot", "v"] += 1.0
    df = spark.createDataFrame(pdf)
    got = {(r["section"], r["name"]): r for r in drift_report(df, "s", variables=["v", "one", "word"]).collect()}
    part = {p: df.where(df.split == p) for p in ("train", "test", "oot")}
    assert len(got) == 5 and got["variable", "one"]["psi"] == 0.0
    assert abs(got["score", "score_psi_oot_vs_test"]["psi"] - calculate_psi(part["test"], part["oot"], "s").first()["psi"]) < 1e-12
    v = variable_psi(part["train"], part["oot"], ["v"]).first()
    assert abs(got["variable", "v"]["psi"] - v["psi"]) < 1e-12 and got["variable", "v"]["interpretation"] == "significant_drift"
    flat = {r["name"]: r["psi"] for r in drift_report(df, "one").collect()}
    assert set(flat.values()) == {0.0} and len(flat) == 3
    loose = RiskConfig(psi_stable_threshold=9.0, psi_moderate_threshold=10.0).psi_bands
    assert variable_psi(part["train"], part["oot"], ["v"], bands=loose).first()["interpretation"] == "stable"


def test_each_check_can_raise(spark):
    import pytest

    from riskframe.operators import quality as q
    df = spark.createDataFrame([(1, -5.0, "x", "2024-01-01"), (1, -5.0, "x", "2024-01-01"), (2, None, "x", None)],
                               "y int, amount double, c string, d string")
    calls = [lambda s: q.check_schema(df.drop("d"), "y", "d", strict=s), lambda s: q.check_target_values(df, "y", strict=s),
             lambda s: q.check_duplicates(df, strict=s), lambda s: q.check_missingness(df, 0.2, strict=s),
             lambda s: q.check_numeric_ranges(df, ("amount",), strict=s), lambda s: q.check_categorical_values(df, strict=s),
             lambda s: q.check_date_order(df, "d", strict=s)]
    for call in calls:
        assert call(False).where("not passed").count() == 1
        with pytest.raises(ValueError):
            call(True)
