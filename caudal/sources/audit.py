"""One audit row per table run."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "entity string, source string, silver string, gold string, processed_rows bigint, "
    "bad_rows bigint, rejected_rows bigint, bad_dates bigint, seconds double, status string, error string, "
    "started timestamp"
)


#: Appends to one folder share its temporary files, so runs that go on at the same time write their rows one after another.
_ONE_WRITER = Lock()


def append(spark: SparkSession, path: str, **values) -> None:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    row = tuple(values.get(n) for n in names)
    with _ONE_WRITER:
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
