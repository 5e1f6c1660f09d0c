"""Gold tables to a stored, evaluated model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from caudal.operators import features, metrics, model, risk
from caudal.schemas import LABEL
from caudal.session import scratch_dir
from caudal.sources import tables


@dataclass
class Training:
    model: PipelineModel
    split: DataFrame        # feature table with label and es_prueba, read from disk
    evaluation: DataFrame


def training_table(users: DataFrame, accounts: DataFrame, transactions: DataFrame, loans: DataFrame) -> DataFrame:
    return risk.with_risk(features.feature_table(users, accounts, transactions, loans))


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Training reads its rows many times, so they are written once to the shared scratch folder;
    a lost executor then costs a re-read, not the joins."""
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fit_and_evaluate(spark: SparkSession, table: DataFrame, model_path: str | None = None, **settings) -> Training:
    """Split, train on three quarters, evaluate on the rest, store the fitted pipeline."""
    split = materialise(spark, model.stratified_split(materialise(spark, table, "features")), "split")
    fitted = model.train(split.where(~F.col("es_prueba")), **settings)
    tested = model.predict(fitted, split.where("es_prueba")).select(
        LABEL, "prediccion_numerica", "probabilidad_alto_riesgo")
    tested = materialise(spark, tested, "tested")
    figures = metrics.evaluation(tested, prediction="prediccion_numerica")
    if model_path:
        model.save(fitted, model_path)
    return Training(fitted, split, figures)


def run(spark: SparkSession, gold_root: str, model_path: str, metrics_path: str | None = None, **settings) -> Training:
    gold = tables.load_all_gold(spark, gold_root)
    table = training_table(gold["usuarios"], gold["cuentas"], gold["transacciones"], gold["prestamos"])
    done = fit_and_evaluate(spark, table, model_path, **settings)
    if metrics_path:
        done.evaluation.withColumn("modelo", F.lit(model_path)).write.mode("append").parquet(metrics_path)
    return done
