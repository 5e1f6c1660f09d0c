"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from caudal.plans import sample_queries

CORE = ["p9_gold_projection_users", "p9_gold_projection_tx", "a1_tx_per_account", "j5_feature_table", "f2_risk_label",
        "a6_frequencies", "a7_risk_crosstab", "a8_histogram", "r3_r4_request_features", "g4_transactions"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_python_and_no_cross_product(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("name", ["p9_gold_projection_tx", "p9_gold_projection_users", "g4_transactions"])
def test_row_local_jobs_do_not_shuffle(spark, sf, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, sf))


def test_scan_is_pruned(spark, sf):
    text = plan(entry.queries()["a1_tx_per_account"](spark, sf))
    assert "l_tax" not in text and "l_shipdate" not in text
    loans = plan(sample_queries.gold(spark, sf, "prestamos").where("monto_otorgado > 0").select("loan_id"))
    assert "o_orderdate" not in re.search(r"ReadSchema: .*", loans)[0]


def test_feature_table_joins_keep_the_partitioning_of_the_aggregates(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(sample_queries.feature_rows(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") <= 6


def test_feature_table_aggregates_before_joining(spark, sf):
    text = plan(sample_queries.feature_rows(spark, sf))
    assert text.count("partial_sum") >= 3
    assert "orderdate" not in text.split("Subquery")[0].split("c_custkey")[0]
