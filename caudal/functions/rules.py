"""Ordered text rules: the first rule whose words all occur in the value decides.

A rule is ``(label, alternatives)``; an alternative is a tuple of words that must all occur.
Order matters. The default tables keep two known faults of the data contract, because results
depend on them: ``EMPLEADO`` is found inside ``DESEMPLEADO`` and ``ACTIV`` inside ``INACTIV``.
``mode="corrected"`` swaps in the tables without these faults.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

SAME = object()  # unmatched values stay as they are


@dataclass(frozen=True)
class RuleTable:
    rules: tuple
    when_null: str = "DESCONOCIDO"
    otherwise: object = SAME


def _table(*rules, **options) -> RuleTable:
    return RuleTable(tuple((label, tuple(alternatives)) for label, *alternatives in rules), **options)


# Labels and search words, in matching order.
RULES = {
    "estado_laboral": _table(
        ("EMPLEADO", ("EMPLEADO",)),
        ("INDEPENDIENTE", ("INDEPENDIENTE",)),
        ("DESEMPLEADO", ("DESEMPLEADO",)),
        ("PENSIONADO", ("PENSIONADO",)),
        ("ESTUDIANTE", ("ESTUDIANTE",)),
        otherwise="OTRO",
    ),
    "nivel_educativo": _table(
        ("NINGUNO", ("NINGUNO",)),
        ("PRIMARIA", ("PRIMARIA",)),
        ("SECUNDARIA", ("SECUNDARIA",)),
        ("TECNICO", ("TECNICO",), ("TÉCNICO",)),
        ("UNIVERSITARIO", ("UNIVERSITARIO",)),
        ("POSTGRADO", ("POSTGRADO",)),
        otherwise="OTRO",
    ),
    "tipo_cuenta": _table(
        ("CORRIENTE", ("CORRIENTE",)),
        ("AHORROS", ("AHORROS",)),
        ("NOMINA", ("NÓMINA",), ("NOMINA",)),
    ),
    "estado_cuenta": _table(
        ("ACTIVA", ("ACTIV",)),
        ("INACTIVA", ("INACTIV",)),
        ("BLOQUEADA", ("BLOQUEAD",)),
    ),
    "tipo_transaccion": _table(
        ("DEPOSITO", ("DEPOSITO",), ("DEPÓSITO",)),
        ("TRANSFERENCIA_ENVIADA", ("TRANSFERENCIA", "ENVIADA")),
        ("TRANSFERENCIA_RECIBIDA", ("TRANSFERENCIA", "RECIBIDA")),
        ("TRANSFERENCIA", ("TRANSFERENCIA",)),
        ("PAGO_PRESTAMO", ("PAGO", "PRESTAMO")),
        ("PAGO_SERVICIO", ("PAGO", "SERVICIO")),
        ("COMPRA", ("COMPRA",)),
        ("RETIRO", ("RETIRO",), ("ATM",)),
        ("SALARIO", ("SALARIO",), ("NÓMINA",)),
    ),
    "categoria": _table(
        ("TECNOLOGIA", ("TECNOLOG",)),
        ("ENTRETENIMIENTO", ("ENTRETENIMIENTO",)),
        ("ROPA_Y_ACCESORIOS", ("ROPA",), ("ACCESORIO",)),
        ("ALIMENTACION", ("ALIMENT",)),
        ("SALUD", ("SALUD",)),
        ("VIAJES", ("VIAJE",)),
        ("HOGAR", ("HOGAR",)),
        ("TRANSPORTE", ("TRANSPORTE",)),
        ("SERVICIO", ("SERVICIO",)),
        ("PAGO_OBLIGACION", ("OBLIGACION",)),
        when_null="OTRO",
    ),
    "proposito": _table(
        ("VIVIENDA", ("VIVIENDA",)),
        ("VEHICULO", ("VEHICULO",), ("VEHÍCULO",)),
        ("EDUCACION", ("EDUCACION",), ("EDUCACIÓN",)),
        ("DEUDA", ("DEUDA",)),
        ("LIBRE_INVERSION", ("LIBRE", "INVERSION")),
        when_null="OTRO",
    ),
    "estado_prestamo": _table(
        ("ACTIVO", ("ACTIV",)),
        ("EN_MORA", ("MORA",)),
        ("PAGADO", ("PAGAD",)),
    ),
    "banco_destinatario": _table(
        ("DAVIPLATA", ("DAVIPLATA",)),
        ("DAVIVIENDA", ("DAVIVIENDA",)),
        ("BANCO_DE_BOGOTA", ("BOGOTA",), ("BOGOTÁ",)),
        ("BANCOLOMBIA", ("BANCOLOMBIA",)),
        ("ITAU", ("ITAU",), ("ITÁU",)),
        ("NEQUI", ("NEQUI",)),
        ("SCOTIABANK_COLPATRIA", ("SCOTIABANK",), ("COLPATRIA",)),
        ("BANCO_AGRARIO", ("AGRARIO",)),
        ("BBVA", ("BBVA",)),
    ),
    "tipo_cuenta_dest": _table(
        ("CORRIENTE", ("CORRIENTE",)),
        ("AHORROS", ("AHORRO",)),
    ),
}

# The longer word is tried first, and payroll is recognised without its accent.
CORRECTED = {
    "estado_laboral": _table(
        ("DESEMPLEADO", ("DESEMPLEADO",)),
        ("EMPLEADO", ("EMPLEADO",)),
        ("INDEPENDIENTE", ("INDEPENDIENTE",)),
        ("PENSIONADO", ("PENSIONADO",)),
        ("ESTUDIANTE", ("ESTUDIANTE",)),
        otherwise="OTRO",
    ),
    "estado_cuenta": _table(
        ("INACTIVA", ("INACTIV",)),
        ("ACTIVA", ("ACTIV",)),
        ("BLOQUEADA", ("BLOQUEAD",)),
    ),
    "tipo_transaccion": RuleTable(
        RULES["tipo_transaccion"].rules[:-1] + (("SALARIO", (("SALARIO",), ("NOMINA",))),)
    ),
}

# Banks without branches.
DIGITAL_BANKS = ["DAVIPLATA", "NEQUI"]


def rule_table(name: str, mode: str = "reference") -> RuleTable:
    if mode not in ("reference", "corrected"):
        raise ValueError(f"unknown rule mode {mode!r}")
    return CORRECTED.get(name, RULES[name]) if mode == "corrected" else RULES[name]


def _matches(value: Column, alternatives) -> Column:
    hit = None
    for words in alternatives:
        every = value.contains(words[0])
        for word in words[1:]:
            every = every & value.contains(word)
        hit = every if hit is None else hit | every
    return hit


def categorise(value: Column, name: str, mode: str = "reference") -> Column:
    """Label of an upper-case text by the named rule table, as one CASE expression."""
    table = rule_table(name, mode)
    case = F.when(value.isNull(), F.lit(table.when_null))
    for label, alternatives in table.rules:
        case = case.when(_matches(value, alternatives), F.lit(label))
    return case.otherwise(value if table.otherwise is SAME else F.lit(table.otherwise))


def bank_kind(bank: Column) -> Column:
    return F.when(bank.isin(DIGITAL_BANKS), F.lit("DIGITAL")).otherwise(F.lit("TRADICIONAL"))


def risk_text(risk: Column, upper: bool = False) -> Column:
    low, high = ("BAJO RIESGO", "ALTO RIESGO") if upper else ("Bajo Riesgo", "Alto Riesgo")
    return F.when(risk == 1, F.lit(high)).otherwise(F.lit(low))
