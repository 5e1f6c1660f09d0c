"""Left-closed bins ``[a, b)`` and 0/1 flags as CASE expressions over the raw column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

INF = float("inf")


@dataclass(frozen=True)
class Bins:
    edges: tuple
    labels: tuple


# Edges and labels. Age labels are one off from their edges on purpose.
BINS = {
    "categoria_ingresos": Bins(
        (-INF, 1_000_000, 3_000_000, 6_000_000, 10_000_000, INF),
        ("MUY BAJOS", "BAJOS", "MEDIOS", "ALTOS", "MUY ALTOS"),
    ),
    "rango_edad": Bins(
        (0, 25, 35, 45, 55, 65, INF),
        ("18-25", "26-35", "36-45", "46-55", "56-65", "65+"),
    ),
    "categoria_saldo": Bins(
        (-INF, 1_000_000, 5_000_000, 10_000_000, 20_000_000, INF),
        ("MUY_BAJO", "BAJO", "MEDIO", "ALTO", "MUY_ALTO"),
    ),
    "monto_transaccion": Bins(
        (-INF, 100_000, 500_000, 1_000_000, 5_000_000, INF),
        ("MUY_PEQUEÑO", "PEQUEÑO", "MEDIANO", "GRANDE", "MUY_GRANDE"),
    ),
    "periodo_dia": Bins(
        (0, 6, 12, 18, 24),
        ("MADRUGADA", "MAÑANA", "TARDE", "NOCHE"),
    ),
    "monto_prestamo": Bins(
        (-INF, 10_000_000, 20_000_000, 30_000_000, 40_000_000, INF),
        ("PEQUEÑO", "MEDIANO", "GRANDE", "MUY_GRANDE", "EXTRA_GRANDE"),
    ),
    "categoria_tasa": Bins(
        (0, 15, 20, 25, 30, INF),
        ("MUY_BAJA", "BAJA", "MEDIA", "ALTA", "MUY_ALTA"),
    ),
}

LARGE_TRANSACTION = 1_000_000
LARGE_LOAN = 20_000_000


def bin_label(value: Column, name: str) -> Column:
    """Label of the bin; null for null, NaN, +inf and anything outside the edges."""
    bins = BINS[name]
    number = value.cast("double")
    case = F.when(number.isNull() | F.isnan(number), F.lit(None).cast("string"))
    if bins.edges[0] != -INF:
        case = case.when(number < float(bins.edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(bins.edges[1:], bins.labels):
        case = case.when(number < float(upper), F.lit(label))
    return case


def bin_order(label: Column, name: str) -> Column:
    """Position of a label within its bins, for sorting."""
    case = F
    for position, text in enumerate(BINS[name].labels):
        case = case.when(label == text, F.lit(position))
    return case


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")
