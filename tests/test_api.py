"""The reference-named surface delegates to the Spark operators."""

from pyspark.sql import functions as F

from riskframe import api
from riskframe.sources.tables import loans


def test_api_names_run(spark, tmp_path):
    l = loans(spark, "/root/testdata/sf0.001")
    tr, te = l.where(F.col("split") == "train"), l.where(F.col("split") == "test")
    assert api.ks_statistic(te, "y", "p").first()["ks"] > 0
    m = api.calculate_metrics(te, "y", "p").first()
    assert abs(m["gini"] - (2 * m["auc"] - 1)) < 1e-12
    summary, detail = api.calculate_psi_detailed(tr, te, "p")
    assert detail.count() >= 2 and summary.first()["psi"] >= 0
    api.save_psi_report(detail, str(tmp_path / "psi"))
    assert api.load_psi_report(spark, str(tmp_path / "psi")).count() == detail.count()
    out, state = api.impute_missing(l.select("l_quantity", "l_tax"), fit=True)
    assert state.numeric == {} and out.count() == l.count()
    assert api.threshold_analysis(te, "y", "p").count() == 50
    assert api.clean_application_train(l).count() == l.count()


def test_api_models_and_attribution(spark):
    from riskframe.sources.tables import LOAN_KEY
    l = loans(spark, "/root/testdata/sf0.001")
    feats = ["l_quantity", "l_discount", "l_tax"]
    tr = l.where(F.col("split") == "train")
    m = api.build_logreg(tr, feats, "y", keys=LOAN_KEY)
    scored = api.predict_proba(m, tr)
    assert scored.where(F.col("pd").isNull()).count() == 0
    shap = api.generate_shap_explanations(m, tr, feats, LOAN_KEY, sample_size=5, n_permutations=2)
    assert shap.count() == 15
    sums = shap.groupBy(*LOAN_KEY).agg(F.sum("attribution").alias("s"), F.first("f_x").alias("fx"),
                                       F.first("f_background").alias("f0")).collect()
    assert all(abs(r["s"] - (r["fx"] - r["f0"])) < 1e-9 for r in sums)
    imp = api.get_feature_importance(m, spark).collect()
    assert {r["feature"] for r in imp} == set(feats)
    rep = api.generate_metrics_json({"test": api.calculate_metrics(tr, "y", "p")}, model="p")
    assert rep.count() == 6
