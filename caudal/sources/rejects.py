"""Records of raw files that don't fit their header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caudal.sources.tables import CORRUPT


def _fields(text: Column) -> Column:
    """Fields of a csv record; quoted values count as one."""
    return F.size(F.split(F.regexp_replace(text, r'"[^"]*+(?:""[^"]*+)*+"', ""), ","))


def _width(raw: DataFrame, *beside: str) -> int:
    return len([c for c in raw.columns if c not in (CORRUPT, *beside)])


def is_unreadable(raw: DataFrame, file_column: str = "_archivo") -> Column:
    """A record with more fields than the header: which value belongs to which column isn't known."""
    return F.col(CORRUPT).isNotNull() & (_fields(F.col(CORRUPT)) > _width(raw, file_column))


def rejected_rows(raw: DataFrame, file_column: str = "_archivo") -> DataFrame:
    """(first, text, file, reason, kept): records that don't fit, with their first value; short ones are kept in the table itself."""
    width = _width(raw, file_column)
    first = next(c for c in raw.columns if c not in (CORRUPT, file_column))
    return raw.where(F.col(CORRUPT).isNotNull()).select(
        F.col(first).alias("first"), F.col(CORRUPT).alias("text"), F.col(file_column).alias("file"),
        F.concat(_fields(F.col(CORRUPT)).cast("string"), F.lit(f" of {width} fields")).alias("reason"),
        (~is_unreadable(raw, file_column)).alias("kept"),
    )
