"""Versions of a stored model, with what a scorer must know about its training."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from caudal.operators import model as models
from caudal.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from caudal.sources import folders


@dataclass(frozen=True)
class About:
    """How the training data of a model were made."""

    rules_mode: str = "reference"
    encoding: str = "levels"
    weights: str = "bootstrap"
    features: tuple = (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions, oldest first."""
    base = f"{root.rstrip('/')}/versions"
    return [v for v in folders.children(spark, base) if folders.exists(spark, f"{base}/{v}/about/_SUCCESS")]


def publish(model: PipelineModel, root: str, about: About = About()) -> str:
    """Stores a new version beside the others and makes it the current one; readers of the version before aren't disturbed.
    The pointer is only moved when everything of the version is in place. One publisher at a time."""
    spark = SparkSession.active()
    base = f"{root.rstrip('/')}/versions"
    taken = [int(v[1:]) for v in folders.children(spark, base) if v[1:].isdigit()]
    name = f"v{max(taken, default=0) + 1:06d}"
    model.write().save(f"{base}/{name}/model")
    _write_text(spark, json.dumps(asdict(about)), f"{base}/{name}/about")
    point_to(spark, root, name)
    return name


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Makes a stored version the current one, also an older one."""
    if version not in versions(spark, root):
        raise models.ModelNotLoaded(f"no complete version {version} below {root}")
    folders.replace(spark, f"{root.rstrip('/')}/current", lambda folder: _write_text(spark, version, folder))


def current(spark: SparkSession, root: str) -> str:
    """The name of the current version."""
    path = f"{root.rstrip('/')}/current"
    folders.recover(spark, path)
    if not folders.exists(spark, path):
        raise models.ModelNotLoaded(f"no model below {root}")
    return spark.read.text(path).first().value


def load(spark: SparkSession, root: str, version: str) -> tuple[PipelineModel, About]:
    base = f"{root.rstrip('/')}/versions/{version}"
    model = models.load(f"{base}/model")
    about = json.loads(spark.read.text(f"{base}/about").first().value)
    return model, About(**{**about, "features": tuple(about["features"])})


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
