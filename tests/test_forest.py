"""Trees with weights of their own, full depth, and level dictionaries of any size."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation, functions as F

from caudal.operators import forest, levels
from caudal.operators.numbering import numbered


def test_draws_are_poisson_and_stable(spark):
    rows = spark.range(20_000).select("id", forest.draws(F.col("id"), 5, 42).alias("draws"))
    counts = {r["n"]: r["c"] for r in rows.select(F.explode("draws").alias("n")).groupBy("n").agg(F.count("*").alias("c")).collect()}
    assert abs(counts[0] / 100_000 - 0.3679) < 0.01 and abs(counts[1] / 100_000 - 0.3679) < 0.01 and abs(counts[2] / 100_000 - 0.1839) < 0.01
    again = spark.range(20_000).repartition(7).select("id", forest.draws(F.col("id"), 5, 42).alias("draws"))
    assert rows.exceptAll(again).count() == 0


def test_classes_weigh_the_same_in_each_bootstrap(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 20 == 0, 1).otherwise(0).alias("y"), forest.draws(F.col("id"), 9, 1).alias("draws"))
    found = forest.class_weights(rows, "y").collect()
    assert len(found) == 18 and all(r["drawn"] >= r["rows"] > 0 for r in found)
    for tree in range(9):
        a, b = (r["drawn"] * r["weight"] for r in found if r["tree"] == tree)
        assert a == pytest.approx(b)
    assert len({r["weight"] for r in found if r["y"] == 1}) > 1  # trees differ


def test_draws_are_computed_once_for_the_weights(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("y"), forest.draws(F.col("id"), 9, 1).alias("draws"))
    plan = forest.class_weights(rows, "y")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1 and "size(" not in plan


@pytest.fixture(scope="module")
def decision_list(spark, tmp_path_factory):
    """One yes-no feature a group, classes in turn: a tree can only take away one group at a time."""
    groups, path = 90, str(tmp_path_factory.mktemp("list") / "rows")
    one = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda j: (j == F.col("id") % groups).cast("double"))
    spark.range(groups * 8).select(
        F.col("id").alias("k"), (F.col("id") % groups % 2).cast("double").alias("y"), array_to_vector(one).alias("features")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_trees_grow_beyond_the_learners_limit(decision_list, tmp_path):
    cut = forest.fit(decision_list, "k", "y", trees=2, depth=30, subset="all")
    whole = forest.fit(decision_list, "k", "y", trees=2, subset="all")
    wrong = [m.transform(decision_list).where("prediction <> y").count() for m in (cut, whole)]
    assert [t.depth for t in cut.trees] == [30, 30] and all(t.depth > 30 for t in whole.trees)
    assert wrong[0] > 0 and wrong[1] == 0
    whole.write().save(f"{tmp_path}/m")
    again = type(whole).load(f"{tmp_path}/m")
    assert again.toDebugString == whole.toDebugString and again.getNumTrees == 2


def test_trees_grow_in_a_session_with_observed_metrics(spark, decision_list, monkeypatch):
    """As after the zones are written: the rows of unfinished leaves are looked up on the executors."""
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 3}
    monkeypatch.setattr(forest, "DEPTH_LIMIT", 20)
    whole = forest.fit(decision_list, "k", "y", trees=1, subset="all")
    assert whole.trees[0].depth > 20 and whole.transform(decision_list).where("prediction <> y").isEmpty()


def test_a_tree_put_together_is_the_tree_itself(decision_list):
    """Where nothing goes on, each tree of the forest is what the learner fitted for its bootstrap."""
    made = forest.fit(decision_list, "k", "y", trees=3, depth=4, seed=7)
    drawn = decision_list.select("*", forest.draws(F.col("k"), 3, 7).alias("draws"))
    weights = {(r["tree"], r["y"]): r["weight"] for r in forest.class_weights(drawn, "y").collect()}
    for t in range(3):
        weight = F.col("draws")[t] * F.when(F.col("y") == 0, weights[t, 0.0]).otherwise(weights[t, 1.0])
        alone = forest._learner("y", "features", 7 + t, 4, "sqrt").fit(drawn.where(F.col("draws")[t] > 0).withColumn("_weight", weight))
        assert made.trees[t].toDebugString.split("\n")[1:] == alone.trees[0].toDebugString.split("\n")[1:]


def test_hundred_thousand_levels(spark, tmp_path):
    rows = spark.range(130_000).selectExpr("if(id < 100000, concat('nivel ', id), 'nivel 77') as a", "id")
    fitted = Pipeline(stages=[levels.LevelIndexer(["a"], ["i"]), OneHotEncoder(inputCols=["i"], outputCols=["v"], handleInvalid="keep")]).fit(rows)
    odd = spark.createDataFrame([("nivel 77",), ("nivel 0",), ("nivel 99999",), ("nuevo",), (None,)], "a string")
    fitted.write().save(f"{tmp_path}/m")
    for model in (fitted, type(fitted).load(f"{tmp_path}/m")):
        got = {r["a"]: r["v"] for r in model.transform(odd).select("a", "v").collect()}
        assert {len(v) for v in got.values()} == {100_000}
        assert got["nuevo"].numNonzeros() == got[None].numNonzeros() == 0
        assert list(got["nivel 77"].indices) == [0] and list(got["nivel 0"].indices) == [1]  # most frequent, then by text
        assert list(got["nivel 99999"].indices) == [99_999]


def test_numbers_have_no_gaps(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), (F.col("id") % 3).alias("g"), F.lit("b").alias("b"))
    got = sorted((r["x"], r["n"]) for r in numbered(df, ["x"], "n").collect())
    assert [n for _, n in got] == list(range(5000))
    for g in range(3):
        mine = sorted((-r["x"], r["n"]) for r in numbered(df, [F.desc("x")], "n", ["g"]).where(F.col("g") == g).collect())
        assert [n for _, n in mine] == list(range(len(mine)))
    assert numbered(df.limit(0), ["x"]).count() == 0


def test_draws_follow_the_numbers_of_the_digests(spark):
    from caudal.operators.hashing import digest, whole

    limits = forest.draw_limits()
    words = F.array(*[whole(digest(F.col("id"), 3, f"bootstrap {t // 4}"), t % 4) for t in range(6)])
    for r in spark.range(3000).select(words.alias("words"), forest.draws(F.col("id"), 6, 3).alias("draws")).collect():
        assert r["draws"] == [sum(word >= limit for limit in limits) for word in r["words"]]


def test_large_bootstraps_have_parts_by_their_rows(decision_list, monkeypatch):
    """Not one for each file and core: each level joins the sums of all parts."""
    monkeypatch.setattr(forest, "PART_ROWS", 300)
    grow, seen = forest._grown, []
    monkeypatch.setattr(forest, "_grown", lambda rows, *rest: seen.append(rows.rdd.getNumPartitions()) or grow(rows, *rest))
    forest.fit(decision_list.repartition(6), "k", "y", trees=2, depth=2)
    assert seen == [2, 2]
