"""Column roles of a trip table and the repair of missing columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Which column of a table plays which part in a trip."""

    time: str = "time"
    vehicle: str = "prefixo_veiculo"
    driver: str = "nome"
    volume: str = "volume_descarregado"
    site: str = "desc_obra"

    @classmethod
    def plain(cls) -> Roles:
        """Roles of a table whose columns are already named after them."""
        return cls("time", "vehicle", "driver", "volume", "site")


TRIP_SCHEMA = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("vehicle", T.StringType()),
        T.StructField("driver", T.StringType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("site", T.StringType()),
    ]
)


def table_defaults(roles: Roles = Roles()) -> dict[str, Column]:
    """Display tables show blanks for missing text and zero for a missing volume."""
    blank = {c: F.lit("") for c in (roles.time, roles.driver, roles.site, roles.vehicle)}
    return {**blank, roles.volume: F.lit(0.0)}


def card_defaults(roles: Roles = Roles()) -> dict[str, Column]:
    """KPI cards treat a missing column as all null; they do not read the site."""
    text = {c: F.lit(None).cast("string") for c in (roles.driver, roles.vehicle)}
    return {
        roles.time: F.lit(None).cast("timestamp_ntz"),
        roles.volume: F.lit(None).cast("double"),
        **text,
    }


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Append each column of ``defaults`` that ``df`` lacks."""
    missing = [value.alias(name) for name, value in defaults.items() if name not in df.columns]
    return df.select("*", *missing) if missing else df
