"""Trips made from the provided tables, always from all of their rows.

``star``: line items as loads, parts as tagged vehicles, suppliers as readers, nations as sites,
orders as driver entries, customers without debt as employees (so some trips have no driver).
``clean``: events as trips with a time of day. ``dirty``: the same with nulls, blanks, spelling
variants and volumes that are no numbers.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill.operators.measures import TripCube, Trips
from tripmill.schema import Roles
from tripmill.sources.star import StarColumns, StarTables

STAR_COLUMNS = StarColumns(
    time="l_shipdate",
    volume="l_quantity",
    tag="l_partkey",
    reader="l_suppkey",
    driver="l_orderkey",
    plant="l_linenumber",
    vehicle_tag="p_partkey",
    vehicle_name="p_brand",
    reader_id="s_suppkey",
    reader_site="s_nationkey",
    site_id="n_nationkey",
    site_name="n_name",
    driver_id="o_orderkey",
    driver_employee="o_custkey",
    employee_id="c_custkey",
    employee_name="c_name",
)

# Values of event_id for which a field is spoiled: (divisor, what the field becomes).
SPOILED_TIME = 29
SPOILED_VOLUME = ((11, "abc"), (13, None), (41, "1d"), (43, "nan"), (5, "0"))


@cache
def _schema(spark: SparkSession, path: str) -> StructType:
    """The schema in the file footers, read once per session and table."""
    return spark.read.parquet(path).schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def star_tables(spark: SparkSession, folder: str) -> StarTables:
    def read(name: str) -> DataFrame:
        return table(spark, folder, name)

    return StarTables(
        loads=read("lineitem"),
        vehicles=read("part"),
        readers=read("supplier"),
        sites=read("nation"),
        drivers=read("orders"),
        employees=read("customer").filter(F.col("c_acctbal") >= 0),
        columns=STAR_COLUMNS,
        unique_drivers=True,
    )


def star_trips(spark: SparkSession, folder: str, *, with_driver: bool = True) -> Trips:
    extract = star_tables(spark, folder).extract(
        names=Roles.plain(), with_driver=with_driver, ordered=False
    )
    return Trips(extract, Roles.plain())


def star_trips_without_driver(spark: SparkSession, folder: str) -> Trips:
    """For rollups that ask for no driver."""
    return star_trips(spark, folder, with_driver=False)


def anonymous_star(spark: SparkSession, folder: str) -> StarTables:
    """The star tables with a third of the loads without a driver id."""
    star = star_tables(spark, folder)
    entry = F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey"))
    return replace(
        star,
        loads=star.loads.withColumn("entry", entry),
        columns=replace(STAR_COLUMNS, driver="entry"),
    )


def crowded_star(spark: SparkSession, folder: str) -> StarTables:
    """The star tables with a third of the loads on one tag, a third on one reader and a third on one driver."""
    star = star_tables(spark, folder)
    line = F.col("l_orderkey") + F.col("l_linenumber")

    def crowded(column: str, rest: int) -> Column:
        return F.when(line % 3 == rest, 1).otherwise(F.col(column)).cast("bigint")

    loads = star.loads.select(
        "l_linenumber",
        "l_shipdate",
        "l_quantity",
        F.col("l_orderkey").alias("load_order"),
        crowded("l_partkey", 0).alias("tag"),
        crowded("l_suppkey", 1).alias("reader"),
        crowded("l_orderkey", 2).alias("entry"),
    )
    columns = replace(STAR_COLUMNS, tag="tag", reader="reader", driver="entry")
    return replace(star, loads=loads, columns=columns)


def fractional_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trips whose volumes use all digits of a double; a few are negative."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) / 7
    return table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("time"),
        F.concat(F.lit("T"), (F.col("l_partkey") % 97).cast("string")).alias("vehicle"),
        F.concat(F.lit("driver "), (F.col("l_suppkey") % 31).cast("string")).alias("driver"),
        F.when(F.col("l_linenumber") == 7, -net).otherwise(net).alias("volume"),
        F.col("l_returnflag").alias("site"),
    )


def fractional_trips(spark: SparkSession, folder: str) -> Trips:
    return Trips(fractional_rows(spark, folder), Roles.plain())


def fractional_cube(spark: SparkSession, folder: str) -> TripCube:
    """The same trips, merged in two steps."""
    fine = fractional_trips(spark, folder).measures("day", "vehicle", "driver", "site")
    return TripCube(fine)


def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("ts").alias("time"),
        F.col("event_type").alias("vehicle"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("driver"),
        F.floor("value").cast("double").alias("volume"),
        F.lit("A").alias("site"),
    )


def _every(divisor: int) -> Column:
    return F.col("event_id") % divisor == 0


def dirty_rows(spark: SparkSession, folder: str) -> DataFrame:
    crew = (F.col("user_id") % 12).cast("string")
    kind = F.col("event_type")
    volume = F.floor("value").cast("int").cast("string")
    for divisor, text in reversed(SPOILED_VOLUME):
        volume = F.when(_every(divisor), F.lit(text)).otherwise(volume)
    return table(spark, folder, "events").select(
        "event_id",
        F.when(~_every(SPOILED_TIME), F.col("ts")).alias("time"),
        F.when(_every(19), None)
        .when(_every(23), "  ")
        .when(_every(7), F.concat(F.lit(" "), F.upper(kind)))
        .otherwise(kind)
        .alias("vehicle"),
        F.when(_every(17), None)
        .when(_every(31), "")
        .when(_every(37), "   ")
        .when(_every(2), F.concat(F.lit("MARIA-D'AVILA  DA SILVA "), crew))
        .otherwise(F.concat(F.lit("maria-d'avila da silva "), crew))
        .alias("driver"),
        volume.alias("volume"),
        F.lit("A").alias("site"),
    )


def clean_trips(spark: SparkSession, folder: str) -> Trips:
    return Trips(clean_rows(spark, folder), Roles.plain())


def dirty_trips(spark: SparkSession, folder: str) -> Trips:
    return Trips(dirty_rows(spark, folder), Roles.plain())
