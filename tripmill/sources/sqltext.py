"""Parameterised SQL text."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def load_dataframe(
    spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Run SQL text with ``:name`` parameters; nothing is fetched until the result is used.

    A naive datetime is bound as its text, so comparing it with a TIMESTAMP_NTZ column does not go
    through the session time zone and still reaches the scan as a pushed filter. For date
    arithmetic write ``CAST(:name AS TIMESTAMP_NTZ)``.
    """
    bound = {
        name: value.isoformat(sep=" ") if isinstance(value, datetime) else value
        for name, value in (params or {}).items()
    }
    return spark.sql(sql, args=bound)
