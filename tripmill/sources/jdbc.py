"""Options for reading the star tables from a relational database."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession


def connection_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options from the variables DB_USER, DB_PASS, DB_HOST, DB_PORT and DB_NAME."""
    env = os.environ if env is None else env
    return {
        "url": f"jdbc:mysql://{env['DB_HOST']}:{env['DB_PORT']}/{env['DB_NAME']}",
        "user": env["DB_USER"],
        "password": env["DB_PASS"],
        "fetchsize": "10000",
        # DATETIME columns have no zone; without this they arrive as instants of the session zone.
        "preferTimestampNTZ": "true",
    }


def table_options(
    table: str,
    *,
    partition_column: str | None = None,
    lower: str | int | datetime | None = None,
    upper: str | int | datetime | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options for one table, split into parallel range reads if a partition column is given.

    The bounds only place the splits; rows outside them are read as well.
    """
    options = {"dbtable": table}
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs both bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def month_predicates(column: str, first: date, last: date) -> list[str]:
    """One condition per month from ``first`` to ``last``, one for everything outside, and one for nulls.

    Together they hold for every row exactly once, so no load is lost or read twice.
    """
    if last < first:
        raise ValueError("the last month is before the first")
    starts = [date(m // 12, m % 12 + 1, 1) for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month + 1)]
    months = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(starts, starts[1:], strict=False)]
    return [*months, f"{column} < '{starts[0]}' OR {column} >= '{starts[-1]}'", f"{column} IS NULL"]


def hash_predicates(column: str, parts: int) -> list[str]:
    """``parts`` conditions of about as many rows each, however unevenly the ids lie; nulls come with the first.

    The remainder is taken of a checksum, so neither gaps nor runs of ids matter.
    """
    if parts < 1:
        raise ValueError("at least one part")
    code = f"MOD(CRC32({column}), {parts})"
    return [f"{code} = {i}" + (f" OR {column} IS NULL" if i == 0 else "") for i in range(parts)]


def read_by_predicates(
    spark: SparkSession, table: str, predicates: Sequence[str], env: Mapping[str, str] | None = None
) -> DataFrame:
    """A lazy table read by one task per predicate; these must hold for every row exactly once.

    For ids or times that lie so unevenly that ranges of equal width would not hold equal numbers of rows.
    """
    if len(predicates) < 2:
        raise ValueError("a fact is read in two parts or more")
    options = connection_options(env)
    url = options.pop("url")
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)


def read_table(
    spark: SparkSession, table: str, env: Mapping[str, str] | None = None, **split
) -> DataFrame:
    """A lazy table for a dimension, read in one task unless split; Spark pushes filters down."""
    options = connection_options(env) | table_options(table, **split)
    return spark.read.format("jdbc").options(**options).load()


def read_fact(
    spark: SparkSession,
    table: str,
    *,
    partition_column: str,
    lower: str | int | datetime,
    upper: str | int | datetime,
    partitions: int,
    env: Mapping[str, str] | None = None,
) -> DataFrame:
    """A lazy table of loads, always read in parallel ranges of ``partition_column``."""
    if partitions < 2:
        raise ValueError("a fact is read in two ranges or more")
    return read_table(
        spark,
        table,
        env,
        partition_column=partition_column,
        lower=lower,
        upper=upper,
        partitions=partitions,
    )
