"""Customer statistics: key figures, frequencies, cross-tabs, histograms, detail rows, options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caudal import schemas
from caudal.functions import bins, rules

# Reported columns, and bins per histogram.
FREQUENCY_COLUMNS = [
    "rango_edad", "estado_laboral", "nivel_educativo", "categoria_ingresos", "tipo_vivienda",
    "riesgo_etiqueta",
]
HISTOGRAMS = {"edad": 10, "ingreso_mensual_estimado": 15, "antiguedad_cliente": 10}
DETAIL_COLUMNS = [
    "user_id", "edad", "rango_edad", "profesion", "ingreso_mensual_estimado",
    "categoria_ingresos", "estado_laboral", "antiguedad_cliente", "num_total_cuentas",
    "saldo_total_en_cuentas", "num_total_prestamos", "monto_total_prestado", "riesgo_etiqueta",
]
DETAIL_ROWS = 20

# Choices always offered, in addition to the observed ones.
OPTIONS = {
    "estado_laboral": ["EMPLEADO", "INDEPENDIENTE", "DESEMPLEADO", "ESTUDIANTE", "PENSIONADO",
                       "OTRO", "DESCONOCIDO"],
    "nivel_educativo": ["NINGUNO", "PRIMARIA", "SECUNDARIA", "TECNICO", "UNIVERSITARIO",
                        "POSTGRADO", "OTRO", "DESCONOCIDO"],
    "estado_civil": ["SOLTERO(A)", "CASADO(A)", "UNION LIBRE", "DIVORCIADO(A)", "VIUDO(A)",
                     "DESCONOCIDO"],
    "tipo_vivienda": ["PROPIA", "ALQUILADA", "FAMILIAR", "OTRO", "DESCONOCIDO"],
}


def with_risk_text(df: DataFrame, label: str = schemas.LABEL) -> DataFrame:
    return df.withColumn("riesgo_etiqueta", rules.risk_text(F.col(label)))


def key_figures(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_clientes"),
        F.avg("ingreso_mensual_estimado").alias("ingreso_promedio"),
        F.avg("edad").alias("edad_promedio"),
        (F.avg(schemas.LABEL) * 100).alias("riesgo_alto_pct"),
    )


def _per_value(df: DataFrame, columns: list[str], *measures: Column) -> DataFrame:
    """Measures per value of each column, ``(columna, valor, ...)``, in one scan; nulls left out."""
    keys = [F.col(c) for c in columns]
    grouped = df.groupingSets([[k] for k in keys], *keys).agg(
        *measures, *[F.grouping(k).alias(f"_off_{c}") for k, c in zip(keys, columns)]
    )
    which, value = F, F
    for c in columns:
        mine = F.col(f"_off_{c}") == 0
        which = which.when(mine, F.lit(c))
        value = value.when(mine, F.col(c).cast("string"))
    named = grouped.withColumns({"columna": which, "valor": value})
    return named.drop(*columns, *[f"_off_{c}" for c in columns]).where(F.col("valor").isNotNull())


def frequencies(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Counts per value for all columns."""
    columns = columns or [c for c in FREQUENCY_COLUMNS if c in df.columns]
    return _per_value(df, columns, F.count("*").alias("n")).select("columna", "valor", "n")


def by_frequency(freq: DataFrame) -> DataFrame:
    """Most frequent value first within each column; ties by value."""
    return freq.orderBy("columna", F.desc("n"), "valor")


def by_category(freq: DataFrame, column: str) -> DataFrame:
    """One column's counts in the order of its bins."""
    return freq.where(F.col("columna") == column).orderBy(
        bins.bin_order(F.col("valor"), column), "valor"
    )


def risk_crosstab(df: DataFrame, by: list[str]) -> DataFrame:
    """Percent of high and low risk within each value of the columns; rows add up to 100."""
    counts = _per_value(
        df, by, F.count_if(F.col(schemas.LABEL) == 1).alias("high"), F.count("*").alias("n")
    )
    low = F.col("n") - F.col("high")
    return counts.select(
        "columna", "valor",
        (F.col("high") / F.col("n") * 100).alias("alto_riesgo_pct"),
        (low / F.col("n") * 100).alias("bajo_riesgo_pct"),
    )


def histograms(df: DataFrame, bins_of: dict[str, int] = HISTOGRAMS) -> DataFrame:
    """Equal-width bins from minimum to maximum per column, last bin closed, empty bins included.

    One scan finds all bounds, a second one counts the bins of all columns. A value's bin comes
    from a quotient, whose rounding is put right by a look at the edges themselves.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in bins_of])
    limits = values.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in bins_of])
    limit = limits.select(F.struct(*bins_of)).scalar()
    long = values.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.lit(n).alias("bins"), F.col(c).alias("x"),
                 limit[c]["lo"].alias("lo"), limit[c]["hi"].alias("hi"))
        for c, n in bins_of.items()
    ]))).where(F.col("x").isNotNull())

    last = F.col("bins") - 1
    guess = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("bins")).cast("int")
    placed = _with_step(long).withColumn("bin", F.least(guess, last))
    edge, next_edge = (F.col("lo") + (F.col("bin") + i) * F.col("step") for i in (0, 1))
    shift = F.when(F.col("x") < edge, -1).when((F.col("x") >= next_edge) & (F.col("bin") < last), 1).otherwise(0)
    counted = placed.groupBy("columna", (F.col("bin") + shift).alias("bin")).agg(F.count("*").alias("n"))

    spine = limits.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.lit(n).alias("bins"), F.col(c)["lo"].alias("lo"), F.col(c)["hi"].alias("hi"))
        for c, n in bins_of.items()
    ]))).where(F.col("lo").isNotNull())
    spine = _with_step(spine).withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    return spine.join(counted, ["columna", "bin"], "left").select(
        "columna", "bin",
        (F.col("lo") + F.col("bin") * F.col("step")).alias("desde"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("hasta"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def _with_step(df: DataFrame) -> DataFrame:
    """Bin width; a column with a single value gets bounds half a unit around it."""
    half = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    wide = df.withColumns({"lo": F.col("lo") - half, "hi": F.col("hi") + half})
    return wide.withColumn("step", (F.col("hi") - F.col("lo")) / F.col("bins"))


def detail(df: DataFrame, rows: int = DETAIL_ROWS) -> DataFrame:
    """First rows by user with the report's columns."""
    shown = schemas.only_existing(df, DETAIL_COLUMNS)
    return shown.orderBy("user_id").limit(rows)


def options(df: DataFrame, columns: tuple = tuple(OPTIONS)) -> DataFrame:
    """Observed values and the fixed choices of each column, each once, sorted."""
    fixed = [(c, choice) for c in columns for choice in OPTIONS[c]]
    observed = frequencies(df, list(columns)).select("columna", F.col("valor").alias("opcion"))
    choices = df.sparkSession.createDataFrame(fixed, "columna string, opcion string")
    return observed.unionByName(choices).distinct().orderBy("columna", "opcion")
