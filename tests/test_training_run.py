"""End-to-end run on the loans view: selection, model choice, reports and artefact round trip."""

from pyspark.sql import functions as F

from riskframe.config import RiskConfig
from riskframe.plans.scoring import score_batch
from riskframe.plans.training_run import load_artifacts, run_training
from riskframe.sources.tables import LOAN_KEY, loans_with_gaps

NUM = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
CAT = ["l_linestatus", "l_returnflag"]


def test_run_and_artifacts(spark, tmp_path):
    df = loans_with_gaps(spark, "/root/testdata/sf0.01").select(*LOAN_KEY, *NUM, *CAT, "y")
    cfg = RiskConfig(target="y", iv_max=0.5, generate_attribution=True, rf_n_estimators=10, rf_max_depth=4)
    res = run_training(spark, df, cfg, LOAN_KEY, artifacts_dir=str(tmp_path / "art"))
    assert set(res.selected) == {"l_quantity", "l_discount"}
    assert res.best_model in ("logreg", "rf")
    m = {r["metric"]: r["value"] for r in res.report.where(F.col("section") == "test").collect()}
    assert 0.66 < m["auc"] < 0.72 and m["ece"] < 0.03
    assert res.psi.first()["psi"] < 0.1
    assert res.rank_comparison.count() == 2
    art = load_artifacts(spark, str(tmp_path / "art"))
    te = loans_with_gaps(spark, "/root/testdata/sf0.01").limit(100)
    scored = score_batch(te, art["encoder"], art["model"], keep=LOAN_KEY).collect()
    assert len(scored) == 100 and all(r["decision"] in ("Approve", "Manual Review", "Decline") for r in scored)
    assert art["metrics"].count() == res.report.count()
    checks = {r["check"]: r["passed"] for r in art["checks"].collect()}
    assert checks["target_values"] and checks["schema"] and "date_order" not in checks and len(checks) == res.checks.count()
    assert art["variable_psi"].count() == res.variable_psi.count()


def test_strict_checks_without_a_date_column(spark):
    import pytest

    from riskframe.plans.training_run import prepare_and_impute
    df = loans_with_gaps(spark, "/root/testdata/sf0.001").select(*LOAN_KEY, "l_linestatus", "l_quantity", "y")
    ready = prepare_and_impute(df, RiskConfig(target="y"), LOAN_KEY, strict=True)
    assert ready.checks.where("not passed").count() == 0 and ready.train.count() + ready.test.count() == df.count()
    with pytest.raises(ValueError):
        prepare_and_impute(df.withColumn("y", F.lit(1)), RiskConfig(target="y"), LOAN_KEY, strict=True)
