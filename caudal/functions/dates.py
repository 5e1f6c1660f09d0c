"""Elapsed time against an explicit ``as_of`` instead of the machine's clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def instant(as_of: str | datetime | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp")


def whole_days(since: Column, as_of) -> Column:
    """Full 24-hour units, rounded down, so half a day ahead of ``as_of`` is -1."""
    micros = F.unix_micros(instant(as_of)) - F.unix_micros(since.cast("timestamp"))
    return F.floor(micros / F.lit(float(MICROS_PER_DAY)))


def whole_years(since: Column, as_of) -> Column:
    return F.floor(whole_days(since, as_of) / F.lit(365.25)).cast("int")


def years_one_decimal(since: Column, as_of) -> Column:
    return F.round(whole_days(since, as_of) / F.lit(365.0), 1)


def date_parts(moment: Column, suffix: str = "", hour: bool = False) -> dict[str, Column]:
    parts = {
        f"anio{suffix}": F.year(moment),
        f"mes{suffix}": F.month(moment),
        f"dia{suffix}": F.dayofmonth(moment),
    }
    if hour:
        parts["hora"] = F.hour(moment)
    return parts
