"""A random forest whose trees each have weights of their own, grown to full depth.

Every tree has a bootstrap of the rows: how often a row is drawn follows from a hash of its key, so it is the same on every
run and partitioning. Class weights are balanced within each bootstrap. Trees are fitted by Spark's tree learner,
several at a time, on the rows of their bootstrap. A tree that the learner had to stop at its depth limit goes on: the rows
of each unfinished leaf are fitted again, and the new tree takes the leaf's place.

The trees are put together in the stored form of Spark's forest, so the result is a plain Spark model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from caudal.operators.hashing import digest
from caudal.session import scratch_dir

#: The tree learner's own limit.
DEPTH_LIMIT = 30
#: Trees that are fitted at the same time.
PARALLEL = 8
#: Rows of a larger bootstrap in one part. Each level of a tree is a pass over its parts whose sums are then joined, so few
#: parts cost little besides the rows themselves; trees fitted at the same time keep the cores busy.
PART_ROWS = 250_000
#: Draws above this have a probability below 1e-10.
MOST_DRAWS = 12
#: A digest holds four draws.
_PER_DIGEST = 4

_NODE = "nodeData"


def draw_limits() -> list[int]:
    """How many 32-bit numbers stand for at most 0, 1, 2 ... draws: the draws of one row in a bootstrap of many rows
    have a Poisson distribution of mean 1."""
    share, total, out = math.exp(-1), 0.0, []
    for k in range(MOST_DRAWS):
        total += share
        out.append(int(total * 2**32))
        share /= k + 1
    return out


def draws(key: Column, trees: int, seed: int) -> Column:
    """How often the bootstrap of each tree draws a row: an array of `trees` integers."""
    limits = [F.lit(f"{x:08x}") for x in draw_limits()]  # hex digits of one length and case stand in the order of their numbers
    words = [
        F.substring(digest(key, seed, f"bootstrap {tree // _PER_DIGEST}"), 1 + 8 * (tree % _PER_DIGEST), 8) for tree in range(trees)
    ]

    def count(word: Column) -> Column:
        """Limits up to the word; they grow, and most words are below the second."""
        found = F
        for n, limit in enumerate(limits):
            found = found.when(word < limit, F.lit(n))
        return found.otherwise(F.lit(len(limits)))

    return F.transform(F.array(*words), count)


def class_weights(rows: DataFrame, label: str, drawn: str = "draws") -> DataFrame:
    """(tree, label, rows, drawn, weight): the weight of one draw, so that all classes of a tree weigh the same. A class
    that a bootstrap has missed has no row. The result has one row a tree and class.

    The draws may be computed here, so they are used once: the plain explode would first test the size of each array."""
    totals = rows.select(label, F.posexplode_outer(drawn).alias("tree", "n")).groupBy("tree", label).agg(
        F.count_if(F.col("n") > 0).alias("rows"), F.sum("n").cast("bigint").alias("drawn")
    ).where("drawn > 0")
    tree = Window.partitionBy("tree")  # a row a class
    weight = F.sum("drawn").over(tree) / (F.count("*").over(tree) * F.col("drawn"))
    return totals.select("tree", label, "rows", "drawn", weight.alias("weight"))


def _learner(label: str, features: str, seed: int, depth: int, subset: str) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, weightCol="_weight", numTrees=1, bootstrap=False, seed=seed,
        maxDepth=depth, featureSubsetStrategy=subset, maxMemoryInMB=512, leafCol="_leaf",
    )


def _nodes(spark: SparkSession, path: str) -> list[dict]:
    """Nodes of a stored tree in the order of their ids: each is followed by its left part, then its right part. A tree is
    as large here as in the model that the learner holds on the driver."""
    rows = spark.read.parquet(f"{path}/data").select(f"{_NODE}.*").collect()
    return sorted((r.asDict(recursive=True) for r in rows), key=lambda r: r["id"])


def _unfinished(nodes: list[dict], depth: int) -> dict[int, int]:
    """{place among the leaves: id} of leaves at the depth limit that still hold rows of several classes."""
    level, leaf, out = {0: 0}, 0, {}
    for node in nodes:
        own = level[node["id"]]
        if node["leftChild"] >= 0:
            level[node["leftChild"]] = level[node["rightChild"]] = own + 1
            continue
        if own == depth and node["impurity"] > 0:
            out[leaf] = node["id"]
        leaf += 1
    return out


def _renumbered(nodes: list[dict], parts: dict[int, list[dict]]) -> list[dict]:
    """One tree in which other trees stand in the place of leaves, numbered anew."""
    trees, out = {None: {n["id"]: n for n in nodes}} | {leaf: {n["id"]: n for n in part} for leaf, part in parts.items()}, []
    todo = [(None, 0, None, "")]
    while todo:
        tree, number, parent, side = todo.pop()
        if tree is None and number in parts:
            tree, number = number, 0
        node = dict(trees[tree][number], id=len(out))
        out.append(node)
        if parent is not None:
            out[parent][side] = node["id"]
        if node["leftChild"] >= 0:
            todo += [(tree, node["rightChild"], node["id"], "rightChild"), (tree, node["leftChild"], node["id"], "leftChild")]
    return out


def _grown(rows: DataFrame, path: str, depth: int, further: bool, settings: dict) -> list[dict] | None:
    """Fits and stores a tree. Where leaves were left unfinished and it is to go `further`, the whole tree's nodes."""
    spark = rows.sparkSession
    # The copy leaves the training summary behind, which holds the session: once that has observed metrics, the summary can't be
    # sent to executors, as the step below for unfinished leaves must.
    fitted = _learner(depth=depth, **settings).fit(rows).copy()
    fitted.write().overwrite().save(path)
    if not further or fitted.trees[0].depth < depth:
        return None
    nodes = _nodes(spark, path)
    leaves = _unfinished(nodes, depth)
    if not leaves:
        return None
    found = vector_to_array("_leaf")[0]
    placed = fitted.transform(rows).where(found.isin(list(leaves))).select(*rows.columns, found.cast("int").alias("_place"))
    kept = f"{path}-rows"
    placed.write.mode("overwrite").partitionBy("_place").parquet(kept)
    parts = {}
    for place, leaf in leaves.items():
        some = spark.read.schema(rows.schema).parquet(f"{kept}/_place={place}")
        below = _grown(some, f"{path}-{leaf}", depth, further, settings) or _nodes(spark, f"{path}-{leaf}")
        if len(below) > 1:
            parts[leaf] = below
    return _renumbered(nodes, parts) if parts else None


def _text(spark: SparkSession, path: str) -> Iterator[dict]:
    return (json.loads(r.value) for r in spark.read.text(path).collect())


def _joined(spark: SparkSession, base: str, trees: int, changed: dict[int, list[dict]]) -> str:
    """The stored form of one forest, from the stored forms of its trees."""
    paths, forest = [f"{base}/tree-{t:05d}" for t in range(trees)], f"{base}/forest"
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/tree-(\d+)/", 1).cast("int")
    data = spark.read.parquet(*[f"{p}/data" for p in paths]).withColumn("treeID", number)
    if changed:
        more = spark.createDataFrame([(t, n) for t, nodes in changed.items() for n in nodes], data.schema)
        data = data.where(~F.col("treeID").isin(list(changed))).unionByName(more)
    data.coalesce(max(trees // 10, 1)).write.mode("overwrite").parquet(f"{forest}/data")
    spark.read.parquet(*[f"{p}/treesMetadata" for p in paths]).withColumn("_1", number).coalesce(1).write.mode(
        "overwrite").parquet(f"{forest}/treesMetadata")
    about = next(_text(spark, f"{paths[0]}/metadata"))
    about["numTrees"] = about["paramMap"]["numTrees"] = trees
    about["paramMap"].pop("leafCol", None)
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{forest}/metadata")
    return forest


def fit(
    rows: DataFrame,
    key: str,
    label: str,
    features: str = "features",
    trees: int = 100,
    depth: int | None = None,
    seed: int = 42,
    subset: str = "sqrt",
    parallel: int = PARALLEL,
) -> RandomForestClassificationModel:
    """A forest over (key, label, features), read from storage: each tree reads them anew.

    Rows with the same key are drawn together. With a `depth`, trees stop there; without one they grow until no leaf can
    be divided.
    """
    spark, base = rows.sparkSession, scratch_dir(rows.sparkSession, "forest")
    drawn = rows.select(key, label, features, draws(F.col(key), trees, seed).alias("draws"))
    path = f"{base}/rows"
    drawn.write.parquet(path)
    drawn = spark.read.schema(drawn.schema).parquet(path)
    weights: dict[int, dict] = {}
    sizes = dict.fromkeys(range(trees), 0)
    for r in class_weights(drawn, label).collect():  # one row a tree and class
        weights.setdefault(r["tree"], {})[r[label]] = r["weight"]
        sizes[r["tree"]] += r["rows"]

    def grow(tree: int):
        weight = F.lit(None).cast("double")
        for value, each in sorted(weights[tree].items()):
            weight = F.when(F.col(label) == value, F.lit(each)).otherwise(weight)
        mine = drawn.where(F.col("draws")[tree] > 0).select(label, features, (F.col("draws")[tree] * weight).alias("_weight"))
        if sizes[tree] > PART_ROWS:
            mine = mine.coalesce(-(-sizes[tree] // PART_ROWS))
        settings = {"label": label, "features": features, "seed": seed + tree, "subset": subset}
        return tree, _grown(mine, f"{base}/tree-{tree:05d}", min(depth or DEPTH_LIMIT, DEPTH_LIMIT), depth is None, settings)

    with ThreadPool(min(parallel, trees)) as pool:
        grown = dict(pool.imap_unordered(inheritable_thread_target(spark)(grow), range(trees)))
    changed = {tree: nodes for tree, nodes in grown.items() if nodes}
    return RandomForestClassificationModel.load(_joined(spark, base, trees, changed)).setProbabilityCol("probability")
