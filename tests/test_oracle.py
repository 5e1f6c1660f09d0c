"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import oracle
from caudal.plans import sample_queries, sample_sql

SQL = sample_sql.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def test_every_statement_has_its_query():
    queries = entry.queries()
    assert set(entry.oracle_sql()) <= set(queries) and set(SQL) <= set(sample_queries.QUERIES)
    # The rows that depend on the forest itself; a contract query stands beside each.
    assert set(sample_queries.QUERIES) - set(SQL) == {"m9_predictions", "m10_evaluation", "r6_score_requests"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, con, name):
    assert oracle.compare(entry.queries()[name](spark, sf), con, SQL[name]) == []


def test_comparison_sees_differences(spark, con):
    df = spark.sql("select 1 as a, 2.0d as b")
    assert oracle.compare(df, con, "SELECT CAST(1 AS INTEGER) AS a, CAST(2 AS DOUBLE) AS b") == []
    assert oracle.compare(df, con, "SELECT CAST(1 AS INTEGER) AS a, CAST(2.5 AS DOUBLE) AS b")
    assert oracle.compare(df, con, "SELECT CAST(1 AS BIGINT) AS a, CAST(2 AS DOUBLE) AS b")


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["estado_laboral"] for r in rows} >= {"EMPLEADO", "ESTUDIANTE"}
