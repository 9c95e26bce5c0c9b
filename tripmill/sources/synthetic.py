"""Generated trips for demonstrations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the demonstration set.
START = "2025-10-01 06:00:00"
HOURS_APART = 8
DRIVERS = ("joao", "carlos", "maria", "ana")
VEHICLES = ("TRK-100", "TRK-200", "TRK-300")
VOLUME_RANGE = (18, 35)


def _draw(size: int, seed: int, salt: str) -> Column:
    """A draw from 0 .. size-1 that depends only on the row id and the seed."""
    return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(size)).cast("int")


def _pick(values: Sequence[str], seed: int, salt: str) -> Column:
    return F.get(F.array(*map(F.lit, values)), _draw(len(values), seed, salt))


def synthetic_trips(spark: SparkSession, n: int = 40, seed: int = 0) -> DataFrame:
    """``n`` trips at a fixed interval, generated in parallel and equal on every run."""
    low, high = VOLUME_RANGE
    start = F.lit(START).cast("timestamp_ntz")
    hours = (F.col("id") * HOURS_APART).cast("int")
    return spark.range(n).select(
        (start + F.make_dt_interval(hours=hours)).alias("time"),
        _pick(DRIVERS, seed, "driver").alias("nome"),
        (low + _draw(high - low + 1, seed, "volume")).alias("volume_descarregado"),
        _pick(VEHICLES, seed, "vehicle").alias("prefixo_veiculo"),
    )
