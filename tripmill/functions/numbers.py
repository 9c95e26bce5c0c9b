"""Numeric coercion, rounding and number text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A plain decimal number, optionally signed, with an optional exponent. Spark's own cast also
# takes "1d", "1.5f" and "nan", which count as missing here.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _finite(value: Column) -> Column:
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def parse_number(text: Column) -> Column:
    """Text to DOUBLE; anything that is not a finite decimal number becomes null."""
    return _finite(F.when(text.rlike(NUMBER_TEXT), text.try_cast("double")))


def number_or_null(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a finite DOUBLE, null where it is not one.

    The expression depends on the column's type, so numeric facts pay for no text parsing.
    """
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _finite(value.cast("double"))
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    return parse_number(value.cast("string"))


def number_or_zero(df: DataFrame, name: str) -> Column:
    """As :func:`number_or_null`, with 0.0 in place of null."""
    return F.coalesce(number_or_null(df, name), F.lit(0.0))


def round2(value: Column) -> Column:
    """Two decimals by scaling and rounding half to even, unlike SQL's half-up ``round``."""
    return F.rint(value * 100) / 100


def number_text(value: Column, decimals: int = 2) -> Column:
    """Brazilian number text such as ``1.234,56``; ``0,00`` for null and non-finite input."""
    finite = _finite(value.cast("double"))
    text = F.translate(F.format_number(finite, decimals), ",.", ".,")
    return F.coalesce(text, F.lit("0,00"))


def point_label(value: Column) -> Column:
    """Whole number with comma grouping, as shown on chart points."""
    return F.format_number(value, 0)


def number_text_if_positive(value: Column) -> Column:
    """:func:`number_text`, or blank when the value is not above zero."""
    return F.when(value > 0, number_text(value)).otherwise("")


def safe_divide(total: Column, count: Column) -> Column:
    """Quotient, or 0.0 where the divisor is zero."""
    return F.coalesce(F.try_divide(total, count), F.lit(0.0))
