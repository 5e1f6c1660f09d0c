"""Tolerant parsing of raw text: a bad value becomes null or zero, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Field texts that a csv reader with default settings takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_tokens(df: DataFrame, skip: tuple = ()) -> DataFrame:
    """Missing-value words to null, in all text columns but those to ``skip``."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]
    return df.withColumns({c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in text})


def is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _java_suffix(column: Column) -> Column:
    """Ends like ``1.0d`` or ``1.0f``, which Java takes as numbers; ``inf`` is none of these."""
    last = F.upper(F.right(F.rtrim(column), F.lit(2)))
    return last.endswith("D") | (last.endswith("F") & ~last.endswith("NF"))


def number(column: Column, text: bool = True) -> Column:
    """Double or null."""
    value = column.try_cast("double")
    if text:
        value = F.when(~_java_suffix(column), value)
    return F.when(~F.isnan(value), value)


def number_or_zero(column: Column, text: bool = True) -> Column:
    return F.coalesce(number(column, text), F.lit(0.0))


def integer_or_zero(column: Column, text: bool = True) -> Column:
    """Fractions are cut off, values outside the integer range count as bad."""
    return F.coalesce(number(column, text).try_cast("int"), F.lit(0))


def timestamp(column: Column, text: bool = True) -> Column:
    """Any ISO shape, judged row by row. A bare time of day is not a timestamp."""
    if not text:
        return column.cast("timestamp")
    bare_time = F.instr(F.ltrim(column), ":").between(1, 8)
    return F.when(~bare_time, F.try_to_timestamp(column))
