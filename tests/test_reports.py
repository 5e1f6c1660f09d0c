"""Reports, metrics and the split against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from caudal.operators import hashing, metrics, model, reports


@pytest.mark.parametrize("seed", range(3))
def test_histogram_like_numpy(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.randrange(18, 75), round(rnd.uniform(0, 1e7), 2) if rnd.random() > 0.1 else None) for _ in range(500)]
    df = spark.createDataFrame(data, "edad int, ingreso double")
    got = reports.histograms(df, {"edad": 10, "ingreso": 15}).orderBy("columna", "bin").collect()
    for i, (c, n) in enumerate((("edad", 10), ("ingreso", 15))):
        counts, edges = np.histogram([r[i] for r in data if r[i] is not None], bins=n)
        mine = [r for r in got if r.columna == c]
        assert [r.n for r in mine] == counts.tolist()
        assert np.allclose([r.desde for r in mine], edges[:-1])


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    got = reports.histograms(df, {"x": 4}).orderBy("bin").collect()
    counts, edges = np.histogram([5.0, 5.0], bins=4)
    assert [r.n for r in got] == counts.tolist() and got[0].desde == edges[0]
    assert reports.histograms(df.where("x > 9"), {"x": 4}).count() == 0


def test_auc_like_spark_and_brute_force(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(2), round(rnd.random(), 2)) for _ in range(800)]
    df = spark.createDataFrame(pairs, "riesgo int, s double").withColumn("riesgo", F.col("riesgo").cast("double"))
    got = metrics.roc_auc(df, score="s").first()[0]
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="riesgo", numBins=0).evaluate(df)
    assert math.isclose(got, brute, abs_tol=1e-12) and math.isclose(got, spark_auc, abs_tol=1e-9)


def test_auc_without_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.1)], "riesgo int, s double")
    assert metrics.roc_auc(df, score="s").first()[0] is None


def test_report_with_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "riesgo int, prediction int")
    got = {r.clase: r for r in metrics.classification_report(df).collect()}
    assert (got["1"].precision, got["1"].recall, got["1"].f1, got["1"].support) == (0.0, 0.0, 0.0, 1)
    assert math.isclose(got["0"].precision, 2 / 3) and got["macro avg"].support == 3
    cells = {(r.real, r.predicho): r.n for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    assert math.isclose(metrics.accuracy(df).first()[0], 2 / 3)


def test_split_is_exact_and_stable(spark):
    rows = [(f"u{i}", int(i % 7 == 0)) for i in range(1003)]
    df = spark.createDataFrame(rows, "user_id string, riesgo int")
    first = model.stratified_split(df).collect()
    again = model.stratified_split(df.repartition(17)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    n = {k: sum(1 for r in first if r.riesgo == k) for k in (0, 1)}
    test = {k: sum(1 for r in first if r.riesgo == k and r.es_prueba) for k in (0, 1)}
    assert sum(test.values()) == math.ceil(0.25 * 1003)
    assert all(abs(test[k] - 0.25 * n[k]) < 1 for k in (0, 1))


def test_choose_per_group_keeps_copies_together(spark):
    df = spark.range(3000).selectExpr("0 as g", "if(id % 3 = 0, -1, id) as k")
    quota = spark.createDataFrame([(0, 600)], "g int, quota bigint")
    got = hashing.choose_per_group(df, "g", "k", quota, 5).groupBy("k").agg(F.count_distinct("chosen").alias("n"))
    assert got.where("n > 1").count() == 0


def test_detail_orders_and_limits(spark):
    df = spark.range(50).selectExpr("lpad(id, 3, '0') as user_id", "1 as edad", "2 as other")
    got = reports.detail(df)
    assert got.columns == ["user_id", "edad"] and [r.user_id for r in got.collect()] == [f"{i:03d}" for i in range(20)]
