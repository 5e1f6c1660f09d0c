"""Zone tables in the session catalog."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def register(spark: SparkSession, database: str, table: str, path: str) -> str:
    """Creates or refreshes an external table over a Parquet folder, also when the folder moved.

    New columns in the files are added to the table. Columns the files no longer have are logged
    and kept.
    """
    name = f"{database}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        stored = spark.read.option("mergeSchema", True).parquet(path).schema
        known = spark.table(name).columns
        added = [f for f in stored if f.name not in known]
        gone = [c for c in known if c not in stored.names]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        if gone:
            log.warning("table %s: columns no longer in the files: %s", name, gone)
    spark.sql(f"REFRESH TABLE {name}")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name
