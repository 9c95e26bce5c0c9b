"""Timestamps without zone: coercion, periods and date text.

Everything stays in TIMESTAMP_NTZ or DATE. Columns of these types, and texts, give results that do not
depend on the session time zone. A TIMESTAMP column is an instant; it is read in the session zone, so
that zone must be the plant's.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The zone of the "generated at" stamp, the period format and its error text.
STAMP_ZONE = "-03:00"
INSTANT_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
INVALID_INSTANT = "Data inválida: forneça no formato YYYY-MM-DD HH:MM:SS"


def instant(value: str | datetime | Column) -> Column:
    """A parameter as TIMESTAMP_NTZ; literals fold to constants and reach the scan."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    if isinstance(value, str):
        value = F.lit(value)
    return value.cast("timestamp_ntz")


def time_or_null(df: DataFrame, name: str) -> Column:
    """Column ``name`` as TIMESTAMP_NTZ, null where it cannot be read as one."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return value
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return value.cast("timestamp_ntz")
    return value.cast("string").try_cast("timestamp_ntz")


def parse_instant(value: Column, default: Column | None = None) -> Column:
    """Strict ``YYYY-MM-DD HH:MM:SS`` text; null or empty text takes ``default``.

    Any other text raises, and so does a missing value without a default.
    """
    spaced = F.regexp_replace(value, r"\s+", " ")
    parsed = F.when(value.rlike(INSTANT_TEXT), spaced.try_cast("timestamp_ntz"))
    invalid = F.raise_error(F.lit(INVALID_INSTANT)).cast("timestamp_ntz")
    fallback = invalid if default is None else F.coalesce(default.cast("timestamp_ntz"), invalid)
    absent = value.isNull() | (value == "")
    return F.when(absent, fallback).otherwise(F.coalesce(parsed, invalid))


def month_start(moment: Column) -> Column:
    """First instant of the month of ``moment``."""
    return F.trunc(moment, "month").cast("timestamp_ntz")


def month_end(moment: Column) -> Column:
    """Last whole second of the month of ``moment``."""
    following = F.add_months(F.trunc(moment, "month"), 1).cast("timestamp_ntz")
    return following - F.expr("INTERVAL 1 SECOND")


def default_period(now: Column | None = None) -> tuple[Column, Column]:
    """The month of ``now``, by default the current one; used where no period is given."""
    now = F.localtimestamp() if now is None else now
    return month_start(now), month_end(now)


def date_text(moment: Column) -> Column:
    return F.date_format(F.to_date(moment), "dd/MM/yyyy")


def iso_date_text(moment: Column) -> Column:
    return F.to_date(moment).cast("string")


def _two_digits(part: Column) -> Column:
    return F.lpad(part.cast("string"), 2, "0")


def clock_text(moment: Column) -> Column:
    """``HH:MM``, seconds cut off."""
    return F.concat_ws(":", _two_digits(F.hour(moment)), _two_digits(F.minute(moment)))


def instant_text(moment: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``, fractions of a second cut off."""
    return F.substring(moment.cast("string"), 1, 19)


def span_text(start: Column, end: Column, lead: str = "De") -> Column:
    """``<lead> dd/mm/yyyy a dd/mm/yyyy``; blank if either end is missing."""
    text = F.concat(F.lit(f"{lead} "), date_text(start), F.lit(" a "), date_text(end))
    return F.coalesce(text, F.lit(""))


def generation_stamp() -> Column:
    """Wall-clock time of the query in the fixed report zone, ``dd/mm/yyyy HH:MM``."""
    now = F.convert_timezone(None, F.lit(STAMP_ZONE), F.current_timestamp())
    return F.concat_ws(" ", date_text(now), clock_text(now))
