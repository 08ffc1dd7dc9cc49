"""Operators that SQL can express give DuckDB's rows on the smallest tables."""

import duckdb
import pytest

from slicewise.llm import queries

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_operator_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"create view {t} as from '{D}/{t}.parquet'")
    cursor = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    got = queries.queries()[name](spark, D)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(cursor.fetchall())


def test_every_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))
