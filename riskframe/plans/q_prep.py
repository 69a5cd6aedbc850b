"""Registered queries: cleaning, splits, imputation and quality checks (P*, V*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.cleaning import CleanRules, clean
from riskframe.operators.impute import fit_imputer, impute
from riskframe.operators.quality import (
    check_categorical_values, check_date_order, check_duplicates, check_period_overlap, check_target_values,
    missing_rates, negative_values, run_all_checks,
)
from riskframe.operators.split import split_label, stratified_split
from riskframe.plans.common import out
from riskframe.plans.registry import register
from riskframe.plans.sql import GAPS_CTE, r6, with_loans
from riskframe.sources.tables import (
    split_filter,
    GAP_COLUMNS, LOAN_KEY, SPLIT_TEST_END, SPLIT_TRAIN_END, loans, loans_with_gaps, read_table,
)

KEYS_SQL = ", ".join(LOAN_KEY)
FIXTURE_RULES = CleanRules(drop_columns=("s_int",), sentinels={"l_linenumber": (7,), "l_discount": (0.0,)},
                           invalid_values={"l_returnflag": ("A",)}, target="y")


@register("clean_sentinels", with_loans(body=f"""SELECT {", ".join(c for c in LOAN_KEY if c != "l_linenumber")},
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS l_linenumber,
  {r6("CASE WHEN l_discount = 0.0 THEN NULL ELSE l_discount END", "l_discount")}, y
FROM loans WHERE l_returnflag IS DISTINCT FROM 'A'"""))
def q_clean_sentinels(spark, sf):
    c = clean(loans(spark, sf), FIXTURE_RULES)
    return out(c.select(*[k for k in LOAN_KEY if k != "l_linenumber"], "l_linenumber", "l_discount", "y"))


@register("drop_invalid_category", with_loans(GAPS_CTE, body="""SELECT l_returnflag, CAST(COUNT(*) AS BIGINT) AS n
FROM gaps WHERE l_returnflag IS DISTINCT FROM 'A' GROUP BY l_returnflag"""))
def q_drop_invalid_category(spark, sf):
    c = clean(loans_with_gaps(spark, sf), CleanRules(invalid_values={"l_returnflag": ("A",)}))
    return c.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("time_split", with_loans(body=f"""SELECT
  CASE WHEN l_shipdate < TIMESTAMP '{SPLIT_TRAIN_END}' THEN 'train' WHEN l_shipdate < TIMESTAMP '{SPLIT_TEST_END}' THEN 'test'
       WHEN l_shipdate IS NOT NULL THEN 'oot' END AS part,
  CAST(COUNT(*) AS BIGINT) AS n, CAST(MIN(l_shipdate) AS VARCHAR) AS date_min, CAST(MAX(l_shipdate) AS VARCHAR) AS date_max,
  {r6("AVG(y)", "bad_rate")}
FROM loans GROUP BY 1"""))
def q_time_split(spark, sf):
    lab = split_label(loans(spark, sf), "l_shipdate", SPLIT_TRAIN_END, SPLIT_TEST_END, "part")
    return out(lab.groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                       F.min("l_shipdate").cast("string").alias("date_min"),
                                       F.max("l_shipdate").cast("string").alias("date_max"),
                                       F.avg("y").alias("bad_rate")))


@register("stratified_split")
def q_stratified_split(spark, sf):
    lab = stratified_split(loans(spark, sf), "y", LOAN_KEY, test_frac=0.2, seed=42)
    return out(lab.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n")))


@register("stratified_split_exact", with_loans(
    "c AS (SELECT y, COUNT(*) AS n, CAST(ROUND(0.2 * COUNT(*)) AS BIGINT) AS k FROM loans GROUP BY y)",
    body="SELECT y, 'test' AS part, k AS n FROM c UNION ALL SELECT y, 'train', n - k FROM c"))
def q_stratified_split_exact(spark, sf):
    """Exact per-class sizes: which rows is decided by key hash, how many is checked by the oracle."""
    lab = stratified_split(loans(spark, sf), "y", LOAN_KEY, test_frac=0.2, seed=42, exact=True)
    return lab.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n"))


IMPUTE_COLS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]

_IMPUTE_STATE_SQL = with_loans(GAPS_CTE, "tr AS (SELECT * FROM gaps WHERE split = 'train')",
    """rf AS (SELECT l_returnflag AS v, COUNT(*) AS c FROM tr WHERE l_returnflag IS NOT NULL GROUP BY 1
              ORDER BY c DESC, v ASC LIMIT 1)""",
    body=f"""SELECT 'l_discount' AS column_name, 'numeric' AS kind, {r6('(SELECT MEDIAN(l_discount) FROM tr)', 'num_value')},
  CAST(NULL AS VARCHAR) AS cat_value
UNION ALL SELECT 'l_tax', 'numeric', ROUND((SELECT MEDIAN(l_tax) FROM tr), 6), NULL
UNION ALL SELECT 'l_returnflag', 'categorical', NULL, (SELECT v FROM rf)""")


def _fit_state(spark, sf):
    tr = loans_with_gaps(spark, sf).where(split_filter("train"))
    return fit_imputer(tr.select(*IMPUTE_COLS))


@register("impute_median_mode", _IMPUTE_STATE_SQL)
def q_impute_state(spark, sf):
    return out(_fit_state(spark, sf).to_frame(spark))


@register("impute_apply", with_loans(GAPS_CTE, "tr AS (SELECT * FROM gaps WHERE split = 'train')",
    """rf AS (SELECT l_returnflag AS v, COUNT(*) AS c FROM tr WHERE l_returnflag IS NOT NULL GROUP BY 1
              ORDER BY c DESC, v ASC LIMIT 1)""",
    """te AS (SELECT COALESCE(l_discount, (SELECT MEDIAN(l_discount) FROM tr)) AS l_discount,
                     COALESCE(l_tax, (SELECT MEDIAN(l_tax) FROM tr)) AS l_tax,
                     COALESCE(l_returnflag, (SELECT v FROM rf)) AS l_returnflag FROM gaps WHERE split = 'test')""",
    body=f"""SELECT l_returnflag, CAST(COUNT(*) AS BIGINT) AS n, {r6('SUM(l_discount)', 'sum_discount')},
  {r6('SUM(l_tax)', 'sum_tax')}, CAST(SUM(CASE WHEN l_discount IS NULL OR l_tax IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing
FROM te GROUP BY l_returnflag"""))
def q_impute_apply(spark, sf):
    state = _fit_state(spark, sf)
    te = impute(loans_with_gaps(spark, sf).where(split_filter("test")), state)
    return out(te.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_discount").alias("sum_discount"), F.sum("l_tax").alias("sum_tax"),
        F.count_if(F.col("l_discount").isNull() | F.col("l_tax").isNull()).alias("n_missing")))


def _with_nan(spark, sf):
    """Loans with NaN (not NULL) in place of a zero discount and tax."""
    l = loans(spark, sf)
    return l.select(*[F.when(F.col(c) == 0, F.lit(float("nan"))).otherwise(F.col(c)).alias(c) for c in ("l_discount", "l_tax")])


@register("missingness_nan", with_loans(body=f"""SELECT 'l_discount' AS column_name,
  {r6("AVG(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END)", "missing_rate")} FROM loans
UNION ALL SELECT 'l_tax', {r6("AVG(CASE WHEN l_tax = 0 THEN 1.0 ELSE 0.0 END)", "missing_rate")} FROM loans"""))
def q_missingness_nan(spark, sf):
    return out(missing_rates(_with_nan(spark, sf)).select("column_name", "missing_rate"))


@register("impute_nan", with_loans("m AS (SELECT MEDIAN(CASE WHEN l_discount <> 0 THEN l_discount END) AS d, MEDIAN(CASE WHEN l_tax <> 0 THEN l_tax END) AS t FROM loans)",
    body=f"""SELECT {r6("SUM(CASE WHEN l_discount = 0 THEN d ELSE l_discount END)", "sum_discount")},
  {r6("SUM(CASE WHEN l_tax = 0 THEN t ELSE l_tax END)", "sum_tax")}, CAST(COUNT(*) AS BIGINT) AS n FROM loans, m"""))
def q_impute_nan(spark, sf):
    df = _with_nan(spark, sf)
    return out(impute(df, fit_imputer(df)).agg(F.sum("l_discount").alias("sum_discount"), F.sum("l_tax").alias("sum_tax"),
                                               F.count(F.lit(1)).alias("n")))


MISSING_THR = 0.1


def _missing_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, {r6(f'AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)', 'missing_rate')}, "
             f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > {MISSING_THR} AS flagged FROM gaps" for c in GAP_COLUMNS]
    return with_loans(GAPS_CTE, body="\nUNION ALL ".join(parts))


@register("check_missingness", _missing_sql())
def q_check_missingness(spark, sf):
    return out(missing_rates(loans_with_gaps(spark, sf), MISSING_THR))


@register("check_duplicates", with_loans(body="""SELECT 'l_orderkey' AS id_column, CAST(COUNT(*) - COUNT(DISTINCT l_orderkey) AS DOUBLE) AS value,
  COUNT(*) = COUNT(DISTINCT l_orderkey) AS passed FROM loans
UNION ALL SELECT 'all_columns', CAST((SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem)) AS DOUBLE),
  (SELECT COUNT(*) FROM lineitem) = (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem))"""))
def q_check_duplicates(spark, sf):
    a = check_duplicates(loans(spark, sf), "l_orderkey").select(F.lit("l_orderkey").alias("id_column"), "value", "passed")
    b = check_duplicates(read_table(spark, sf, "lineitem")).select(F.lit("all_columns").alias("id_column"), "value", "passed")
    return a.unionByName(b)


@register("check_target_values", with_loans(body="""SELECT 'y' AS target, SUM(CASE WHEN y IS NULL OR y NOT IN (0, 1) THEN 1 ELSE 0 END) = 0 AS passed,
  CAST(SUM(CASE WHEN y IS NULL OR y NOT IN (0, 1) THEN 1 ELSE 0 END) AS DOUBLE) AS value FROM loans
UNION ALL SELECT 'l_linenumber', SUM(CASE WHEN l_linenumber IS NULL OR l_linenumber NOT IN (0, 1) THEN 1 ELSE 0 END) = 0,
  CAST(SUM(CASE WHEN l_linenumber IS NULL OR l_linenumber NOT IN (0, 1) THEN 1 ELSE 0 END) AS DOUBLE) FROM loans"""))
def q_check_target_values(spark, sf):
    l = loans(spark, sf)
    a = check_target_values(l, "y").select(F.lit("y").alias("target"), "passed", "value")
    b = check_target_values(l, "l_linenumber").select(F.lit("l_linenumber").alias("target"), "passed", "value")
    return a.unionByName(b)


@register("check_numeric_ranges", """SELECT 'c_custkey' AS column_name, CAST(COUNT(*) FILTER (c_custkey < 0) AS BIGINT) AS n_negative,
  FALSE AS keyword_match, FALSE AS flagged FROM customer
UNION ALL SELECT 'account_balance', CAST(COUNT(*) FILTER (c_acctbal < 0) AS BIGINT), TRUE, COUNT(*) FILTER (c_acctbal < 0) > 0 FROM customer
UNION ALL SELECT 'Credit_Limit', CAST(COUNT(*) FILTER (c_acctbal < -2000) AS BIGINT), TRUE, COUNT(*) FILTER (c_acctbal < -2000) > 0 FROM customer
UNION ALL SELECT 'c_acctbal', CAST(COUNT(*) FILTER (c_acctbal < 0) AS BIGINT), FALSE, FALSE FROM customer""")
def q_check_numeric_ranges(spark, sf):
    c = read_table(spark, sf, "customer")
    return negative_values(c.select("c_custkey", F.col("c_acctbal").alias("account_balance"),
                                    (F.col("c_acctbal") + 2000).alias("Credit_Limit"), "c_acctbal"))


@register("check_constant_categories", with_loans(body="""SELECT 'l_linestatus' AS column_name, MIN(l_linestatus) = MAX(l_linestatus) AS is_constant FROM loans WHERE l_returnflag = 'A'
UNION ALL SELECT 'l_returnflag', MIN(l_returnflag) = MAX(l_returnflag) FROM loans WHERE l_returnflag = 'A'
UNION ALL SELECT 'split', MIN(split) = MAX(split) FROM loans WHERE l_returnflag = 'A'"""))
def q_check_constant_categories(spark, sf):
    l = loans(spark, sf).where(F.col("l_returnflag") == "A").select("l_linestatus", "l_returnflag", "split", "p")
    res = check_categorical_values(l)
    flagged = res.select(F.explode("issues").alias("msg")).select(F.regexp_extract("msg", "'([^']+)'", 1).alias("c"))
    cols = l.sparkSession.createDataFrame([(c,) for c in ("l_linestatus", "l_returnflag", "split")], "column_name string")
    return (cols.join(flagged.withColumnRenamed("c", "column_name").withColumn("is_constant", F.lit(True)),
                      on="column_name", how="left")
            .select("column_name", F.coalesce("is_constant", F.lit(False)).alias("is_constant")))


CORRUPT_PRIORITY = "1-URGENT"


@register("check_dates", f"""SELECT 'o_orderdate' AS column_name,
  CAST(SUM(CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END) AS DOUBLE) AS value,
  SUM(CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END) = 0 AS passed FROM orders
UNION ALL SELECT 'o_orderdate_text',
  CAST(SUM(CASE WHEN TRY_CAST(d AS TIMESTAMP) IS NULL THEN 1 ELSE 0 END) AS DOUBLE),
  SUM(CASE WHEN TRY_CAST(d AS TIMESTAMP) IS NULL THEN 1 ELSE 0 END) = 0
FROM (SELECT CASE WHEN o_orderpriority = '{CORRUPT_PRIORITY}' THEN 'not a date' ELSE CAST(o_orderdate AS VARCHAR) END AS d FROM orders)""")
def q_check_dates(spark, sf):
    o = read_table(spark, sf, "orders")
    a = check_date_order(o, "o_orderdate").select(F.lit("o_orderdate").alias("column_name"), "value", "passed")
    txt = o.select(F.when(F.col("o_orderpriority") == CORRUPT_PRIORITY, F.lit("not a date"))
                   .otherwise(F.col("o_orderdate").cast("string")).alias("d"))
    b = check_date_order(txt, "d").select(F.lit("o_orderdate_text").alias("column_name"), "value", "passed")
    return a.unionByName(b)


@register("check_period_overlap", with_loans(
    "b AS (SELECT split, MIN(l_shipdate) AS dmin, MAX(l_shipdate) AS dmax FROM loans GROUP BY split)",
    """h AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'train' WHEN l_orderkey % 3 = 1 THEN 'test' ELSE 'oot' END AS split,
             MIN(l_shipdate) AS dmin, MAX(l_shipdate) AS dmax FROM loans GROUP BY 1)""",
    body="""SELECT 'by_date' AS labelling,
  CAST((SELECT dmax FROM b WHERE split = 'train') < (SELECT dmin FROM b WHERE split = 'test')
   AND (SELECT dmax FROM b WHERE split = 'test') < (SELECT dmin FROM b WHERE split = 'oot') AS BOOLEAN) AS passed,
  CAST(CASE WHEN (SELECT dmax FROM b WHERE split = 'train') >= (SELECT dmin FROM b WHERE split = 'test') THEN 1 ELSE 0 END
     + CASE WHEN (SELECT dmax FROM b WHERE split = 'test') >= (SELECT dmin FROM b WHERE split = 'oot') THEN 1 ELSE 0 END AS BIGINT) AS n_issues
UNION ALL SELECT 'by_key',
  CAST((SELECT dmax FROM h WHERE split = 'train') < (SELECT dmin FROM h WHERE split = 'test')
   AND (SELECT dmax FROM h WHERE split = 'test') < (SELECT dmin FROM h WHERE split = 'oot') AS BOOLEAN),
  CAST(CASE WHEN (SELECT dmax FROM h WHERE split = 'train') >= (SELECT dmin FROM h WHERE split = 'test') THEN 1 ELSE 0 END
     + CASE WHEN (SELECT dmax FROM h WHERE split = 'test') >= (SELECT dmin FROM h WHERE split = 'oot') THEN 1 ELSE 0 END AS BIGINT)"""))
def q_check_period_overlap(spark, sf):
    l = loans(spark, sf)
    by_key = l.withColumn("split", F.element_at(F.array(F.lit("train"), F.lit("test"), F.lit("oot")),
                                                (F.col("l_orderkey") % 3 + 1).cast("int")))
    a = check_period_overlap(l, "l_shipdate").select(F.lit("by_date").alias("labelling"), "passed",
                                                     F.size("issues").cast("long").alias("n_issues"))
    b = check_period_overlap(by_key, "l_shipdate").select(F.lit("by_key").alias("labelling"), "passed",
                                                          F.size("issues").cast("long").alias("n_issues"))
    return a.unionByName(b)


FORBIDDEN = ["l_returnflag", "recovery_amount"]


@register("run_all_checks", with_loans(
    "b AS (SELECT split, MIN(l_shipdate) AS dmin, MAX(l_shipdate) AS dmax FROM loans GROUP BY split)",
    body="""SELECT 'schema' AS "check", (SELECT COUNT(DISTINCT y) = 2 AND COUNT(*) = COUNT(y) FROM loans) AS passed,
  CAST((SELECT COUNT(DISTINCT y) FROM loans) AS DOUBLE) AS value
UNION ALL SELECT 'target_values', (SELECT SUM(CASE WHEN y IN (0, 1) THEN 0 ELSE 1 END) = 0 FROM loans), 0.0
UNION ALL SELECT 'duplicates', (SELECT COUNT(*) FROM loans) = (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM loans)),
  CAST((SELECT COUNT(*) FROM loans) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM loans)) AS DOUBLE)
UNION ALL SELECT 'missingness', TRUE, 0.0
UNION ALL SELECT 'numeric_ranges', TRUE, NULL
UNION ALL SELECT 'categorical_values', TRUE, NULL
UNION ALL SELECT 'date_order', (SELECT COUNT(*) = COUNT(l_shipdate) FROM loans), CAST((SELECT COUNT(*) - COUNT(l_shipdate) FROM loans) AS DOUBLE)
UNION ALL SELECT 'leakage', FALSE, 1.0
UNION ALL SELECT 'period_overlap', (SELECT dmax FROM b WHERE split = 'train') < (SELECT dmin FROM b WHERE split = 'test')
   AND (SELECT dmax FROM b WHERE split = 'test') < (SELECT dmin FROM b WHERE split = 'oot'), NULL"""))
def q_run_all_checks(spark, sf):
    l = loans(spark, sf)
    res = run_all_checks(l, "y", "l_shipdate", forbidden=FORBIDDEN, labelled=l)
    return res.select("check", "passed", "value")


def _profile_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM gaps"
             for c in GAP_COLUMNS]
    return with_loans(GAPS_CTE, f"m AS ({' UNION ALL '.join(parts)})",
                      body="SELECT * FROM m ORDER BY n_missing DESC, column_name LIMIT 20")


@register("column_profile", _profile_sql())
def q_column_profile(spark, sf):
    """The 20 columns with the most missing values (a top-k report)."""
    from riskframe.operators.cleaning import profile
    _, missing = profile(loans_with_gaps(spark, sf), "y", top=20)
    return missing


@register("target_counts", with_loans(GAPS_CTE, body="SELECT y, CAST(COUNT(*) AS BIGINT) AS count FROM gaps GROUP BY y"))
def q_target_counts(spark, sf):
    """The target distribution of the profile."""
    from riskframe.operators.cleaning import profile
    counts, _ = profile(loans_with_gaps(spark, sf), "y")
    return counts
