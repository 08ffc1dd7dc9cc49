"""Every query with SQL gives DuckDB's rows on the smallest tables; the others run."""

import math

import duckdb
import pytest

from slicewise.plans import registry

D = "/root/testdata/sf0.001"
TABLES = ["events", "embeddings", "part"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as from '{D}/{t}.parquet'")
    return c


def shown(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, bool):
        return str(value)
    return f"{float(value):.6f}" if isinstance(value, (int, float)) else str(value)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, con, name):
    got = registry.queries()[name](spark, D)
    cursor = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(columns)
    expected = sorted(tuple(shown(v) for v in row) for row in cursor.fetchall())
    assert sorted(tuple(shown(v) for v in row) for row in got.select(*columns).collect()) == expected
    assert expected


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, D).count() > 0


def test_objects_are_linked_once_before_they_are_rescaled(spark):
    plan = registry.queries()["relabel_rescaled"](spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and not any(x in plan for x in ("MapInArrow", "SortMergeJoin", "Window"))


def test_entry_and_guard():
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries()) and set(registry.oracle_sql()) <= set(entry.oracle_sql())


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["plate", "treatment_dose", "failed_organoids", "total_organoids", "proportion_failed"]
