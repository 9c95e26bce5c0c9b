"""Site names by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def site_name(
    sites: DataFrame, site: int, id_column: str = "id", name_column: str = "desc_obra"
) -> DataFrame:
    """One row with the name of a site, or ``Obra <id>`` if it has none."""
    name = F.max(name_column)
    found = sites.filter(F.col(id_column) == site).agg(name.alias("name"))
    return found.select(F.coalesce("name", F.lit(f"Obra {site}")).alias("site_name"))


def site_names(sites: DataFrame, id_column: str = "id", name_column: str = "desc_obra") -> DataFrame:
    """``id, name`` of all sites that have a name."""
    named = sites.filter(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id"))
    return named.agg(F.max(name_column).alias("name"))


def brand(site: Column, primary_sites: tuple[str, ...]) -> Column:
    """Brand A for the listed sites, B for all others and for an unknown site."""
    return F.when(site.isin(*primary_sites), "A").otherwise("B")
