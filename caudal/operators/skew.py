"""Left joins that stay balanced when one key, or null, holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caudal.session import scratch_dir

SALTS = 64              # pieces a heavy key is cut into
MIN_SHARE = 0.002       # share of all rows from which a key counts as heavy
MIN_ROWS = 1_000_000    # keys below this many rows never matter
TRACKED = 2048          # size of the heavy-hitter sketch, independent of the data
MERGERS = 256           # sketches are merged in two steps, first into this many


def heavy_keys(df: DataFrame, key: Column, min_rows: int = MIN_ROWS) -> list[int]:
    """Hashes of the keys that hold a large share of the rows.

    A frequent-items sketch finds them in one scan of the key columns without shuffling the keys.
    At most ``1 / MIN_SHARE`` = 500 keys can pass the threshold, so the list that reaches the
    driver is bounded whatever the data. It is fetched once and used as a constant: both sides of
    a join must see the very same list, and two runs of a sketch need not agree on borderline keys.
    """
    partial = df.groupBy((F.spark_partition_id() % MERGERS).alias("part")).agg(
        F.call_function("approx_top_k_accumulate", key, F.lit(TRACKED)).alias("sketch"),
        F.count("*").alias("n"),
    )
    # grouped by a constant, so that an empty table gives no row instead of an empty sketch
    merged = partial.groupBy(F.lit("all")).agg(
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(TRACKED)).alias("sketch"),
        F.sum("n").alias("n"),
    )
    found = merged.select(
        F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(int(1 / MIN_SHARE))).alias("top"), "n"
    ).select(F.inline("top"), "n")
    limit = F.greatest(F.col("n") * MIN_SHARE, F.lit(float(min_rows)))
    return [r["item"] for r in found.where(F.col("count") >= limit).select("item").collect()]


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    min_rows: int = MIN_ROWS,
    heavy_on: list[str] | None = None,
    heavy_list: list | None = None,
) -> DataFrame:
    """``left`` LEFT JOIN ``right``, where ``right`` has one row per key.

    Rows of a heavy key, and rows whose key is null, get a salt taken from ``spread_by``; the
    heavy keys' rows on the right are repeated once per salt. All other keys keep salt 0 and join
    as usual. Exact for any list of heavy keys: a left row has one salt, and its match exists for
    each salt. Looking for heavy keys runs one small job on the key columns of ``left``, unless
    ``heavy_list`` has them from an earlier one. ``heavy_on``, some of the join columns, may stand for the key.
    """
    key = F.xxhash64(*(heavy_on or on))
    if heavy_list is None:
        heavy_list = heavy_keys(left.select(*on), key, min_rows)
    heavy = key.isin(heavy_list)
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    salted_left = left.withColumn("_salt", F.when(no_key | heavy, salt).otherwise(F.lit(0)))
    copies = F.when(heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(copies))
    return salted_left.join(salted_right, [*on, "_salt"], "left").drop("_salt")


def dealt(df: DataFrame) -> DataFrame:
    """The rows in as many parts as a shuffle has, and no fewer than there are cores: for small rows, from few files or parts, of
    which each is much work or becomes many rows. They are stored so, and what follows needs no shuffle."""
    spark = df.sparkSession
    path = scratch_dir(spark, "dealt")
    df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
