"""Rule-based credit-risk label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from caudal.schemas import LABEL


def risk_rules() -> list[Column]:
    """Any of these marks a user as high risk. Unknown values never match."""
    income = F.col("ingreso_mensual_estimado")
    loans = F.col("num_total_prestamos")
    return [
        (income < 1_500_000) & (F.col("antiguedad_cliente") < 2),
        F.col("estado_laboral").isin("DESEMPLEADO", "ESTUDIANTE") & (loans > 0),
        (income < 2_000_000) & (loans > 1),
        (F.col("edad") < 22) & (income == 0),
    ]


def with_risk(df: DataFrame, rule_column: str | None = None) -> DataFrame:
    """Adds the 0/1 label and, on request, the number of the first rule that fired."""
    first = F
    for number, condition in enumerate(risk_rules(), start=1):
        first = first.when(condition, F.lit(number))
    added = {LABEL: F.when(first.isNotNull(), F.lit(1)).otherwise(F.lit(0))}
    if rule_column:
        added[rule_column] = first
    return df.withColumns(added)


def label_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Share of each label value among rows that have one."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over one row per label value
    return counts.select(label, "n", (F.col("n") / total).alias("share"))
