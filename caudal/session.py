"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8,000 bytes; wide rule projections would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Dates are zone-less wall times, so the session zone is pinned to UTC."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("caudal")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


class NoSharedFolder(RuntimeError):
    """A cluster session names no folder for intermediate tables."""


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only in local mode may the session name none: then it is the machine's own temporary folder. On a cluster
    executors would each write to a disk of their own, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"caudal-{name}-")
    return os.path.join(base, f"caudal-{name}-{uuid.uuid4().hex}")
