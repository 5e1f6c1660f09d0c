"""Risk classifier: feature selection, split, class weights, forest, prediction, storage."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from caudal.functions import rules
from caudal.operators import forest
from caudal.operators.hashing import choose_per_group
from caudal.operators.levels import LevelIndexer
from caudal.schemas import CATEGORICAL_FEATURES, LABEL, NOT_FEATURES, NUMERIC_FEATURES, UNKNOWN
from caudal.session import scratch_dir
from caudal.sources import folders

# Fixed values of the training recipe.
SEED = 42
TEST_SHARE = 0.25
TREES = 100

MAX_LEVELS = 5_000     # columns with more levels get a stored dictionary instead of the driver's list
HASH_SIZE = 1 << 14


def select_features(df: DataFrame) -> DataFrame:
    """Model inputs only: identifiers, raw dates and the label go."""
    return df.drop(*NOT_FEATURES, LABEL)


def feature_types(df: DataFrame) -> dict[str, list[str]]:
    """Text columns are categorical, numeric columns numeric, others neither."""
    found = {"categorical": [], "numeric": []}
    for f in select_features(df).schema:
        if isinstance(f.dataType, T.StringType):
            found["categorical"].append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            found["numeric"].append(f.name)
    return found


def feature_profile(df: DataFrame) -> DataFrame:
    """Per feature: kind, filled rows, and levels or mean and population deviation."""
    kinds = feature_types(df)
    numeric = kinds["numeric"]
    moments = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in numeric],
        *[F.avg(c).alias(f"m_{c}") for c in numeric],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in numeric],
    )
    stacked = ", ".join(f"'{c}', n_{c}, m_{c}, s_{c}" for c in numeric)
    numbers = moments.selectExpr(
        f"stack({len(numeric)}, {stacked}) as (feature, filled, mean, deviation)"
    ).select("feature", F.lit("numeric").alias("kind"), "filled",
             F.lit(None).cast("bigint").alias("levels"), "mean", "deviation")
    texts = kinds["categorical"]
    pairs = ", ".join(f"'{c}', {c}" for c in texts)
    levels = (
        df.selectExpr(f"stack({len(texts)}, {pairs}) as (feature, level)")
        .groupBy("feature", "level").agg(F.count("*").alias("n"))
        .groupBy("feature").agg(
            F.coalesce(F.sum(F.when(F.col("level").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"),
            F.count("level").alias("levels"),
        )
        .select("feature", F.lit("categorical").alias("kind"), "filled", "levels",
                F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("deviation"))
    )
    return numbers.unionByName(levels)


def class_quotas(df: DataFrame, label: str = LABEL, share: float = TEST_SHARE) -> DataFrame:
    """Test rows per class: ceil(share * rows) in total, split by largest remainder.

    The windows run over one row per class.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    total = F.sum("n").over(every)
    ideal = counts.withColumn("wanted", F.ceil(total * share)).withColumn(
        "ideal", F.col("n") * F.col("wanted") / total
    )
    floors = ideal.withColumn("base", F.floor("ideal").cast("bigint"))
    order = Window.orderBy(F.desc(F.col("ideal") - F.col("base")), F.col(label))
    extra = F.row_number().over(order) <= F.col("wanted") - F.sum("base").over(every)
    return floors.select(label, "n", (F.col("base") + extra.cast("bigint")).alias("quota"))


def stratified_split(
    df: DataFrame, key: str = "user_id", label: str = LABEL, share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Adds ``es_prueba``: an exact share of every class, stable under repartitioning."""
    quotas = class_quotas(df, label, share)
    chosen = choose_per_group(df.where(F.col(label).isNotNull()), label, key, quotas, seed)
    return chosen.withColumnRenamed("chosen", "es_prueba")


def with_class_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight n / (classes * n_class). The table of weights has one row per class; rows without label keep a null weight."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    every = Window.partitionBy()
    weight = F.sum("_n").over(every) / (F.count("*").over(every) * F.col("_n"))
    counted = counts.where(F.col(label).isNotNull()).select(label, weight.alias("peso"))
    return df.join(counted, label, "left").select(label, *[c for c in df.columns if c != label], "peso")


def prepare(df: DataFrame) -> DataFrame:
    """Nulls become 0 or the unknown level, so no row is lost in the encoders."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMERIC_FEATURES}
        | {c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in CATEGORICAL_FEATURES}
    )


def encoders(df: DataFrame, encoding: str) -> list:
    """Encoding of text columns: ``levels`` is one-hot over all levels, ``hash`` a hashed vector of fixed size.

    The indexes of levels are the same wherever they are kept: up to MAX_LEVELS in the indexer's memory, beyond that in
    a stored table."""
    if encoding not in ("levels", "hash"):
        raise ValueError(f"unknown encoding {encoding!r}")
    indexed, hashed = (CATEGORICAL_FEATURES, []) if encoding == "levels" else ([], CATEGORICAL_FEATURES)
    long = []
    if indexed:
        levels = df.agg(*[F.count_distinct(c).alias(c) for c in indexed]).first()
        long = [c for c in indexed if levels[c] > MAX_LEVELS]
    stages = [
        VectorAssembler(inputCols=NUMERIC_FEATURES, outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True),
    ]
    parts = ["_scaled"]
    if indexed:
        # keep + dropLast: a level not seen in training becomes an all-zero vector
        short = [c for c in indexed if c not in long]
        if short:
            stages += [
                StringIndexer(inputCols=short, outputCols=[f"_i_{c}" for c in short], handleInvalid="keep"),
                OneHotEncoder(inputCols=[f"_i_{c}" for c in short], outputCols=[f"_v_{c}" for c in short], dropLast=True),
            ]
        if long:
            stages += [
                LevelIndexer([*long], [f"_i_{c}" for c in long]),
                OneHotEncoder(inputCols=[f"_i_{c}" for c in long], outputCols=[f"_v_{c}" for c in long],
                              dropLast=True, handleInvalid="keep"),
            ]
        parts += [f"_v_{c}" for c in indexed]
    if hashed:
        stages.append(FeatureHasher(inputCols=hashed, outputCol="_hashed", numFeatures=HASH_SIZE))
        parts.append("_hashed")
    return stages + [VectorAssembler(inputCols=parts, outputCol="features")]


def train(
    training: DataFrame,
    trees: int = TREES,
    depth: int | None = None,
    seed: int = SEED,
    encoding: str = "levels",
    weights: str = "bootstrap",
    key: str = "user_id",
) -> PipelineModel:
    """Fits encoders and forest on rows that carry the label. Without a ``depth`` trees grow until no leaf can be divided.

    ``weights="bootstrap"`` balances the classes within the bootstrap of each tree, which is fitted by itself.
    ``"global"`` gives all trees the weights of the whole table and fits them in common passes, for tables too large to be
    read once a tree; trees then stop at the learner's limit of depth.
    """
    if weights not in ("bootstrap", "global"):
        raise ValueError(f"unknown weights {weights!r}")
    rows = prepare(training.where(F.col(LABEL).isNotNull()))
    if weights == "global":
        grown = RandomForestClassifier(
            featuresCol="features", labelCol=LABEL, weightCol="peso", numTrees=trees,
            maxDepth=depth or forest.DEPTH_LIMIT, seed=seed, probabilityCol="probability",
        )
        # The copy leaves the training summary behind, which holds the session and cannot be shipped
        # to executors once the session has observed metrics.
        rows = with_class_weight(rows)
        return Pipeline(stages=[*encoders(rows, encoding), grown]).fit(rows).copy()
    fitted = Pipeline(stages=encoders(rows, encoding)).fit(rows)
    path = scratch_dir(training.sparkSession, "encoded")
    fitted.transform(rows).select(key, F.col(LABEL).cast("double"), "features").write.parquet(path)
    encoded = training.sparkSession.read.parquet(path)
    return PipelineModel([*fitted.stages, forest.fit(encoded, key, LABEL, trees=trees, depth=depth, seed=seed)])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Class, label text and both probabilities next to the input columns."""
    scored = model.transform(prepare(df))
    probability = vector_to_array("probability")
    return scored.select(
        *[F.col(c) for c in df.columns],
        F.col("prediction").cast("int").alias("prediccion_numerica"),
        rules.risk_text(F.col("prediction")).alias("prediccion_etiqueta"),
        probability[0].alias("probabilidad_bajo_riesgo"),
        probability[1].alias("probabilidad_alto_riesgo"),
    )


def save(model: PipelineModel, path: str) -> None:
    """Replaces a stored model; a reader finds the old one until the new one is complete."""
    folders.replace(SparkSession.active(), path, lambda folder: model.write().save(folder))


class ModelNotLoaded(RuntimeError):
    """The stored model is missing or unusable."""


def load(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as problem:
        raise ModelNotLoaded(f"model at {path} could not be loaded: {problem}") from problem
