"""Numbered account lists per user, and picking one of a user's own accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from caudal.operators.hashing import digest
from caudal.operators.skew import MIN_ROWS, heavy_keys, spread_left_join


def account_list(accounts: DataFrame) -> DataFrame:
    """Each user's accounts numbered from 1, with the user's total, one row per account.

    The list stays in long form: a user with very many accounts is numbered slice by slice and
    never gathered in one task. Slices are the first two digits of the account's hash.
    """
    sliced = accounts.where(F.col("user_id").isNotNull()).withColumn(
        "_slice", F.substring(digest(F.col("account_id")), 1, 2)
    )
    sizes = sliced.groupBy("user_id", "_slice").agg(F.count("*").alias("_size"))
    user = Window.partitionBy("user_id")
    earlier = user.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(  # at most 256 rows per user
        "user_id", "_slice",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_size").over(user).alias("num_cuentas"),
    )
    within = Window.partitionBy("user_id", "_slice").orderBy("account_id")
    return (
        sliced.withColumn("_nth", F.row_number().over(within))
        .join(starts, ["user_id", "_slice"])
        .withColumn("orden", F.col("_start") + F.col("_nth"))
        .drop("_slice", "_start", "_nth")
    )


def pick_account(
    rows: DataFrame, accounts: DataFrame, draw: Column, spread_by: list[str], min_rows: int = MIN_ROWS
) -> DataFrame:
    """Gives every row one of its user's accounts and that account's opening date.

    ``draw`` is a non-negative integer per row. Rows of users without accounts are left out.
    """
    owners = accounts.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count("*").alias("num_cuentas"))
    # One search for heavy users serves both joins.
    heavy = {"heavy_on": ["user_id"], "heavy_list": heavy_keys(rows.select("user_id"), F.xxhash64("user_id"), min_rows)}
    counted = spread_left_join(rows, owners, ["user_id"], spread_by, **heavy)
    counted = counted.where(F.col("num_cuentas").isNotNull()).withColumn(
        "orden", F.pmod(draw, F.col("num_cuentas")) + 1
    )
    listed = account_list(accounts.select("user_id", "account_id", "fecha_apertura"))
    chosen = listed.select("user_id", "orden", "account_id", "fecha_apertura")
    return spread_left_join(counted, chosen, ["user_id", "orden"], spread_by, **heavy).drop("orden")
