"""Cleaning (raw to silver) and enrichment (silver to gold) of the five banking tables.

All steps are row-local expressions, so neither direction shuffles. Work is split into stages of
``withColumns`` so that a normalised text is computed once and then tested by many rules.
Columns a table lacks are skipped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from caudal import schemas
from caudal.functions import bins, coerce, dates, rules, text


@dataclass(frozen=True)
class Options:
    """``rules``: "reference" or "corrected". ``on_bad_date``: "null" or "fail"."""

    rules: str = "reference"
    on_bad_date: str = "null"
    strict_mask: bool = False


@dataclass(frozen=True)
class Cleaning:
    """Which columns of a table get which treatment."""

    texts: tuple = ()
    timestamps: tuple = ()
    numbers: tuple = ()            # bad value becomes null
    zero_numbers: tuple = ()       # bad value becomes 0
    zero_integers: tuple = ()
    categories: tuple = ()
    ages: dict = field(default_factory=dict)        # source timestamp -> new column
    masked: str | None = None
    parts: tuple = ()              # (timestamp, suffix, with hour)
    name: str | None = None
    dropped: tuple = ()


# The columns of each table by treatment.
CLEANING = {
    "usuarios": Cleaning(
        texts=("nombre", "apellido", "ciudad_residencia", "profesion", "estado_laboral",
               "nivel_educativo", "estado_civil", "tipo_vivienda"),
        timestamps=("fecha_de_nacimiento", "fecha_registro_banco"),
        zero_numbers=("ingreso_mensual_estimado",),
        zero_integers=("numero_dependientes",),
        categories=("estado_laboral", "nivel_educativo"),
        ages={"fecha_de_nacimiento": "edad", "fecha_registro_banco": "antiguedad_cliente"},
    ),
    "cuentas": Cleaning(
        texts=("tipo_cuenta", "moneda", "estado_cuenta"),
        timestamps=("fecha_apertura",),
        numbers=("saldo_actual",),
        categories=("tipo_cuenta", "estado_cuenta"),
        masked="numero_cuenta",
        parts=("fecha_apertura", "_apertura", False),
    ),
    "destinatarios": Cleaning(
        texts=("nombre_registrado", "banco_destinatario", "tipo_cuenta_dest"),
        categories=("banco_destinatario", "tipo_cuenta_dest"),
        masked="numero_cuenta_dest",
        name="nombre_registrado",
    ),
    "transacciones": Cleaning(
        texts=("tipo_transaccion", "categoria", "canal", "tipo_tarjeta_usada"),
        timestamps=("fecha",),
        zero_numbers=("monto",),
        categories=("tipo_transaccion", "categoria"),
        parts=("fecha", "", True),
        dropped=("descripcion",),
    ),
    "prestamos": Cleaning(
        texts=("proposito", "estado_prestamo"),
        timestamps=("fecha_desembolso",),
        numbers=("monto_otorgado", "tasa_interes_anual", "plazo_meses", "cuota_mensual"),
        categories=("proposito", "estado_prestamo"),
        parts=("fecha_desembolso", "_desembolso", False),
    ),
}


def _years(source: str, as_of, options: Options) -> Column:
    years = dates.whole_years(F.col(source), as_of)
    if options.on_bad_date == "fail":
        stop = F.raise_error(F.lit(f"missing or unreadable date in {source}"))
        return F.when(F.col(source).isNull(), stop.cast("int")).otherwise(years)
    return years


def clean(df: DataFrame, entity: str, as_of, options: Options = Options()) -> DataFrame:
    """Raw text table to typed silver table."""
    plan = CLEANING[entity]
    df = df.drop(*plan.dropped)
    have = set(df.columns)

    typed: dict[str, Column] = {}
    for c in have.intersection(plan.texts):
        typed[c] = text.normalise(F.col(c))
    for treat, columns in (
        (coerce.timestamp, plan.timestamps),
        (coerce.number, plan.numbers),
        (coerce.number_or_zero, plan.zero_numbers),
        (coerce.integer_or_zero, plan.zero_integers),
    ):
        for c in have.intersection(columns):
            typed[c] = treat(F.col(c), coerce.is_text(df, c))
    df = df.withColumns({c: typed[c] for c in df.columns if c in typed})

    derived = {c: rules.categorise(F.col(c), c, options.rules) for c in plan.categories if c in have}
    for source, age in plan.ages.items():
        if source in have:
            derived[age] = _years(source, as_of, options)
    if plan.name in have:
        derived["primer_nombre"] = text.name_part(F.col(plan.name), 0)
        derived["primer_apellido"] = text.name_part(F.col(plan.name), 1)
    if plan.masked in have:
        derived["numero_cuenta_masked"] = text.mask_account(F.col(plan.masked), options.strict_mask)
    if plan.parts and plan.parts[0] in have:
        source, suffix, hour = plan.parts
        derived.update(dates.date_parts(F.col(source), suffix, hour))
    return df.withColumns(derived) if derived else df


def _enrich_usuarios(as_of):
    yield "categoria_ingresos", ("ingreso_mensual_estimado",), lambda c: bins.bin_label(c, "categoria_ingresos")
    yield "rango_edad", ("edad",), lambda c: bins.bin_label(c, "rango_edad")
    yield "tiene_dependientes", ("numero_dependientes",), lambda c: bins.flag(c > 0)
    yield "vivienda_propia", ("tipo_vivienda",), lambda c: bins.flag(c == "PROPIA")


def _enrich_cuentas(as_of):
    yield "categoria_saldo", ("saldo_actual",), lambda c: bins.bin_label(c, "categoria_saldo")
    yield "antiguedad_anios", ("fecha_apertura",), lambda c: dates.years_one_decimal(c, as_of)
    yield "cuenta_protegida", ("tipo_cuenta",), lambda c: bins.flag(c == "AHORROS")
    yield "cuenta_bloqueada", ("estado_cuenta",), lambda c: bins.flag(c == "BLOQUEADA")


def _enrich_destinatarios(as_of):
    yield "tipo_banco", ("banco_destinatario",), rules.bank_kind
    yield "cuenta_protegida", ("tipo_cuenta_dest",), lambda c: bins.flag(c == "AHORROS")


def _enrich_transacciones(as_of):
    yield "categoria_monto", ("monto",), lambda c: bins.bin_label(c, "monto_transaccion")
    yield "transaccion_grande", ("monto",), lambda c: bins.flag(c > bins.LARGE_TRANSACTION)
    yield "periodo_dia", ("hora",), lambda c: bins.bin_label(c, "periodo_dia")


def total_interest(principal: Column, yearly_rate: Column, months: Column) -> Column:
    return principal * (yearly_rate / 100) * (months / 12)


def _enrich_prestamos(as_of):
    yield "categoria_monto", ("monto_otorgado",), lambda c: bins.bin_label(c, "monto_prestamo")
    yield "prestamo_grande", ("monto_otorgado",), lambda c: bins.flag(c > bins.LARGE_LOAN)
    yield "categoria_tasa", ("tasa_interes_anual",), lambda c: bins.bin_label(c, "categoria_tasa")
    yield ("interes_total_estimado", ("monto_otorgado", "tasa_interes_anual", "plazo_meses"),
           total_interest)


_ENRICHMENT = {
    "usuarios": _enrich_usuarios,
    "cuentas": _enrich_cuentas,
    "destinatarios": _enrich_destinatarios,
    "transacciones": _enrich_transacciones,
    "prestamos": _enrich_prestamos,
}


def enrich(df: DataFrame, entity: str, as_of, keep: tuple = ()) -> DataFrame:
    """Silver table to gold table: bins, flags, derived numbers, fixed column order.

    Columns in ``keep`` are carried along behind the gold columns.
    """
    added = {
        name: build(*map(F.col, inputs))
        for name, inputs, build in _ENRICHMENT[entity](as_of)
        if set(inputs) <= set(df.columns)
    }
    return schemas.only_existing(df.withColumns(added) if added else df, schemas.GOLD_COLUMNS[entity] + list(keep))


def refine(df: DataFrame, entity: str, as_of, options: Options = Options()) -> DataFrame:
    """Raw table straight to gold, for use without a silver zone in between."""
    return enrich(clean(coerce.null_tokens(df), entity, as_of, options), entity, as_of)
