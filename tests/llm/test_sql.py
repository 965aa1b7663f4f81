"""Queries that SQL expresses, against their SQL."""

import duckdb
import pytest

from demandspark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_sql(spark, key):
    con = duckdb.connect(config={"memory_limit": "8GB"})
    for name in ("documents", "benchmark", "conversations", "embeddings", "pages"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    want = con.execute(ORACLE_SQL[key])
    columns = [d[0] for d in want.description]
    df = QUERIES[key](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
