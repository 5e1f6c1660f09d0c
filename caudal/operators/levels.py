"""Level dictionaries: category indexes for text columns with any number of levels.

The indexer of Spark's library holds all levels of a column on the driver and in each task. Here they are a table, made by a
distributed ranking and joined to the rows, with the same indexes: most frequent level first, ties in order of the text.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from caudal.operators.numbering import numbered
from caudal.session import scratch_dir


def level_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, level, place): the index of each level of the columns, from 0. Nulls are no level."""
    stacked = ", ".join(f"'{c}', `{c}`" for c in columns)
    counts = df.selectExpr(f"stack({len(columns)}, {stacked}) as (feature, level)").where("level is not null").groupBy(
        "feature", "level").agg(F.count("*").alias("_n"))
    return numbered(counts, [F.desc("_n"), F.col("level")], "place", ["feature"]).select("feature", "level", "place")


class LevelIndexer(Estimator, HasInputCols, HasOutputCols):
    def __init__(self, inputCols: list[str], outputCols: list[str]):
        super().__init__()
        self._set(inputCols=inputCols, outputCols=outputCols)

    def _fit(self, df: DataFrame) -> LevelIndexerModel:
        path = scratch_dir(df.sparkSession, "levels")
        level_dictionary(df, self.getInputCols()).write.partitionBy("feature").parquet(path)
        model = LevelIndexerModel(path)
        return model._set(inputCols=self.getInputCols(), outputCols=self.getOutputCols())


class LevelIndexerModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """Adds each column's index as a double; a null or a level not seen in fitting gets the number of levels."""

    def __init__(self, path: str | None = None):
        super().__init__()
        self.path = path
        self._sizes: dict[str, int] | None = None

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("level string, place bigint, feature string").parquet(self.path)

    def sizes(self, spark: SparkSession) -> dict[str, int]:
        """Number of levels of each column."""
        if self._sizes is None:
            found = self.table(spark).groupBy("feature").agg(F.max("place").alias("most")).collect()
            self._sizes = dict.fromkeys(self.getInputCols(), 0) | {r["feature"]: r["most"] + 1 for r in found}
        return self._sizes

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        for c, out in zip(self.getInputCols(), self.getOutputCols(), strict=True):
            levels = self.table(spark).where(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("place").alias(out))
            known = F.coalesce(out, F.lit(self.sizes(spark)[c])).cast("double").alias(out)
            df = df.join(levels, F.col(c) == F.col("_level"), "left").select(*df.columns, known)
        return df

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: LevelIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table(self.sparkSession).write.partitionBy("feature").parquet(f"{path}/levels")


class _Reader(MLReader):
    def load(self, path: str) -> LevelIndexerModel:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LevelIndexerModel(f"{path}/levels")
        model._resetUid(about["uid"])
        DefaultParamsReader.getAndSetParams(model, about)
        return model
