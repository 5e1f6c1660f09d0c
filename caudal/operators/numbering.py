"""Gapless numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from caudal.session import scratch_dir


def numbered(df: DataFrame, order: list[Column | str], name: str = "number", within: list[str] | None = None) -> DataFrame:
    """Adds a bigint from 0 without gaps, in the given order, for each group of `within` by itself. Rows that the order
    doesn't tell apart get numbers in any order.

    Rows are dealt out in ranges of the order and stored, ranges are counted, and a row's number is its place within its
    range behind all ranges before it. A group of any size is spread over many ranges.
    """
    spark, within = df.sparkSession, within or []
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "numbered")
    # Stored, because the bounds of the ranges are sampled and must not change between the two uses below.
    df.repartitionByRange(partitions, *within, *order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*within, "_range").agg(F.count("*").alias("_rows")).withColumn(
        "_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    starts = starts.select("_range", "_start", *[F.col(c).alias(f"_within_{i}") for i, c in enumerate(within)])
    place = F.row_number().over(Window.partitionBy(*within, "_range").orderBy(*order))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(within):
        same = same & F.col(c).eqNullSafe(F.col(f"_within_{i}"))
    return (
        placed.withColumn("_place", place).join(starts.withColumnRenamed("_range", "_r"), same)
        .select(*df.columns, (F.col("_start") + F.col("_place") - 1).alias(name))
    )
