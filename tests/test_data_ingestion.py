"""Rule-based cleaning of the application table."""

from riskframe.operators.cleaning import APPLICATION_RULES, clean

SCHEMA = ("SK_ID_CURR int, TARGET double, DAYS_BIRTH int, DAYS_EMPLOYED int, CODE_GENDER string, "
          "DAYS_LAST_PHONE_CHANGE int, REGION_RATING_CLIENT int, REGION_RATING_CLIENT_W_CITY int")


def _raw(spark):
    return spark.createDataFrame([
        (1, 0.0, -9000, 365243, "M", 0, -1, 2),
        (2, 1.0, -12000, -300, "XNA", -50, 2, -1),
        (3, 0.0, -15000, -100, None, -10, 1, 1),
    ], SCHEMA)


def test_identifier_dropped_and_target_int(spark):
    out = clean(_raw(spark), APPLICATION_RULES)
    assert "SK_ID_CURR" not in out.columns
    assert dict(out.dtypes)["TARGET"] == "int"


def test_sentinels_become_null(spark):
    rows = {r["DAYS_BIRTH"]: r for r in clean(_raw(spark), APPLICATION_RULES).collect()}
    r = rows[-9000]
    assert r["DAYS_EMPLOYED"] is None and r["DAYS_LAST_PHONE_CHANGE"] is None and r["REGION_RATING_CLIENT"] is None
    assert r["REGION_RATING_CLIENT_W_CITY"] == 2


def test_invalid_category_dropped_missing_kept(spark):
    out = clean(_raw(spark), APPLICATION_RULES)
    genders = [r["CODE_GENDER"] for r in out.collect()]
    assert "XNA" not in genders and None in genders and len(genders) == 2


def test_absent_columns_skipped(spark):
    df = spark.createDataFrame([(1, 0)], "a int, TARGET int")
    assert clean(df, APPLICATION_RULES).columns == ["a", "TARGET"]
