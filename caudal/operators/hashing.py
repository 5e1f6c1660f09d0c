"""Repeatable pseudo-random choices from MD5, independent of partitioning and engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def digest(*parts: Column | str | int) -> Column:
    """32 hex digits for a tuple of values."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]).cast("binary"))


def whole(hexdigits: Column, draw: int) -> Column:
    """One of the four 32-bit integers in a digest."""
    return F.conv(F.substring(hexdigits, 1 + 8 * draw, 8), 16, 10).cast("bigint")


def below(hexdigits: Column, draw: int, bound: int | Column) -> Column:
    """Integer in ``[0, bound)``, ``bound`` up to 2^31."""
    return F.shiftright(whole(hexdigits, draw) * bound, 32)


def uuid_text(hexdigits: Column) -> Column:
    return F.concat_ws("-", *[F.substring(hexdigits, a, n) for a, n in
                              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


BUCKET_DIGITS = 4  # 65,536 slices of the hash space


def choose_per_group(df: DataFrame, group: str, key: str, quotas: DataFrame, seed: int) -> DataFrame:
    """Adds ``chosen``: true for the ``quota`` rows of a group with the smallest key hashes.

    ``quotas`` has one row per group. Nothing is broadcast by hint: where groups are few, the size check does it. No group is sorted as a whole: hash slices are counted first, the running
    count finds the slice in which the quota is reached, and only that slice is looked at hash by
    hash. Rows with the same key always fall on the same side.
    """
    hashed = df.withColumn("_hash", digest(F.col(key), seed))
    keyed = hashed.select(group, "_hash", F.substring("_hash", 1, BUCKET_DIGITS).alias("_slice"))
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        keyed.groupBy(group, "_slice").agg(F.count("*").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .join(quotas.select(group, "quota"), group)
        .where((F.col("_before") < F.col("quota")) & (F.col("_before") + F.col("_size") >= F.col("quota")))
        .select(group, "_slice", (F.col("quota") - F.col("_before")).alias("_open"))
    )
    upto = Window.partitionBy(group).orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        keyed.join(slices, [group, "_slice"])
        .groupBy(group, "_hash", "_open").agg(F.count("*").alias("_n"))
        .withColumn("_reached", F.sum("_n").over(upto))
        .where(F.col("_reached") >= F.col("_open"))
        .groupBy(group).agg(F.min("_hash").alias("_cut"))
    )
    placed = hashed.join(cuts, group, "left")
    return placed.withColumn(
        "chosen", F.coalesce(F.col("_hash") <= F.col("_cut"), F.lit(False))
    ).drop("_hash", "_cut")
