"""Every corpus query that has SQL against it."""

import duckdb
import pytest
from comparing import difference

from marketlens.llm import catalogue

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert difference(catalogue.queries()[name](spark, FOLDER), con, catalogue.oracle_sql()[name]) is None
