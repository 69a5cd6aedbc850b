from collections import defaultdict

from pyspark.sql import functions as F

from riskframe.llm import exact_dedup

SCHEMA = "doc_id long, text string, kept string, h int"
ROWS = [(3, "a b", "x", 1), (1, "ab", "x", 1), (2, "a  b\n", "x", 1), (4, None, None, None), (5, "", "x", 1), (6, " \t", "x", 1),
        (7, "z" * 200_000, "x", 1), (8, "z" * 200_000, "x", 1), (9, "ab\u00a0", "x", 1), (10, "c", None, 2),
        (11, "d", None, 2), (11, "d", None, 2), (None, "c ", None, None), (12, "q", "", 1), (12, "r", "", 1)]


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        t = r[1] or ""
        by["".join(c for c in t if c not in " \t\n\x0b\x0c\r")].append((-len(t), r[0] is None, r[0] or 0, r[0]))
    out = set()
    for g in by.values():
        best = min(g, key=lambda x: x[:3])
        out |= {(x[3], best[3], len(g), x[3] == best[3] and x[0] == best[0]) for x in g}
    return out


def got(df):
    return {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()}


def test_groups_match_brute_force_with_nulls_ties_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    res = exact_dedup.exact_groups(df)
    assert got(res) == brute(ROWS) and res.count() == len(ROWS) - 1


def test_hash_collisions_are_separated_by_bytes(spark):
    rows = [(i, f"t{i % 7}" + " " * (i % 3), "", 0) for i in range(600)]
    weak = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA), hash_fn=lambda t: F.lit("same"))
    assert got(weak) == brute(rows)


def test_empty_table_and_stage_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0
    stage = exact_dedup.without_copies(df)
    assert stage.columns == df.columns
    assert sorted(str(r.doc_id) for r in stage.collect()) == sorted(
        str(x) for x in [2, 6, 7, 9, None, 11, 12, 12])
