"""Corpus queries with an SQL oracle, compared on the small tables."""

import duckdb
import pytest

from riskframe.llm.queries import ORACLES, QUERIES
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert canon(QUERIES[name](spark, SF).toPandas()) == canon(con.sql(ORACLES[name]).df())
