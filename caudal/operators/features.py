"""One feature row per user: aggregate first, then join, so no join multiplies rows.

Every aggregation combines on the map side, and distinct accounts are counted in two steps, so a
busy account or user costs no more than any other. The left sides
of the joins have unique keys, so no key of theirs can be heavy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caudal import schemas
from caudal.functions import coerce


def _amount(df: DataFrame, column: str):
    return coerce.number_or_zero(F.col(column), coerce.is_text(df, column))


def transactions_per_account(transactions: DataFrame) -> DataFrame:
    amount = _amount(transactions, "monto")
    return (
        transactions.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(
            F.count("transaction_id").alias("num_total_transacciones_cuenta"),
            F.sum(amount).alias("monto_total_transacciones_cuenta"),
            F.avg(amount).alias("monto_promedio_transaccion_cuenta"),
        )
    )


def accounts_with_activity(
    accounts: DataFrame, per_account: DataFrame
) -> DataFrame:
    """Accounts without transactions keep nulls, which later averages must skip."""
    return accounts.join(per_account, "account_id", "left")


def accounts_per_user(accounts_activity: DataFrame) -> DataFrame:
    return (
        accounts_activity.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count_distinct("account_id").alias("num_total_cuentas"),
            F.sum(_amount(accounts_activity, "saldo_actual")).alias("saldo_total_en_cuentas"),
            F.avg("num_total_transacciones_cuenta").alias("promedio_transacciones_por_cuenta"),
            F.coalesce(F.sum("monto_total_transacciones_cuenta"), F.lit(0.0))
            .alias("monto_total_movido_por_usuario"),
        )
    )


def loans_per_user(loans: DataFrame) -> DataFrame:
    amount = _amount(loans, "monto_otorgado")
    return (
        loans.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count("loan_id").alias("num_total_prestamos"),
            F.sum(amount).alias("monto_total_prestado"),
            F.avg(amount).alias("promedio_monto_prestamo"),
        )
    )


def join_per_user(users: DataFrame, per_user: DataFrame) -> DataFrame:
    return users.join(per_user, "user_id", "left")


def zero_fill(df: DataFrame) -> DataFrame:
    return df.fillna(0, [*schemas.ACCOUNT_FEATURES, *schemas.LOAN_FEATURES])


def user_aggregates(
    accounts: DataFrame, transactions: DataFrame, loans: DataFrame
) -> DataFrame:
    """All seven aggregates by user. Both sides come out of an aggregation by ``user_id``, so
    the full join needs no shuffle of its own."""
    needed = accounts.select("account_id", "user_id", "saldo_actual")
    activity = accounts_with_activity(needed, transactions_per_account(transactions))
    return accounts_per_user(activity).join(loans_per_user(loans), "user_id", "full")


def feature_table(
    users: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    loans: DataFrame,
) -> DataFrame:
    """Gold tables to the training table without label. Empty inputs give zeros."""
    per_user = user_aggregates(accounts, transactions, loans)
    joined = zero_fill(join_per_user(users, per_user))
    return joined.select(*users.columns, *schemas.ACCOUNT_FEATURES, *schemas.LOAN_FEATURES)
