"""Chart series: one total per day, vehicle or driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.dates import iso_date_text
from tripmill.functions.numbers import point_label
from tripmill.functions.text import driver_label_series, wrap_label
from tripmill.operators.measures import MeasureSource


def daily_series(source: MeasureSource) -> DataFrame:
    """Total per day in date order; days without trips are not filled in."""
    days = source.measures("day").filter(F.col("day").isNotNull())
    return days.select(*source.scope, "day", F.col("volume").alias("total")).orderBy(*source.scope, "day")


def daily_points(source: MeasureSource) -> DataFrame:
    """:func:`daily_series` with the texts shown at each point."""
    return daily_series(source).select(
        *source.scope,
        "day",
        "total",
        point_label(F.col("total")).alias("label"),
        iso_date_text(F.col("day")).alias("day_label"),
    )


def vehicle_series(source: MeasureSource) -> DataFrame:
    """Total per vehicle, largest first; null vehicles are left out, blank ones are not."""
    vehicles = source.measures("vehicle").filter(F.col("vehicle").isNotNull())
    return vehicles.select(*source.scope, "vehicle", F.col("volume").alias("total")).orderBy(
        *source.scope, F.desc("total"), "vehicle"
    )


def driver_series(source: MeasureSource) -> DataFrame:
    """Total per raw driver name, largest first, labelled after grouping.

    Spelling variants of a name therefore stay separate rows and may carry equal labels.
    """
    # Sorted before labelling: a range sort samples its input, and would compute labels twice.
    drivers = source.measures("driver", blank=True).orderBy(*source.scope, F.desc("volume"), "driver")
    return drivers.select(
        *source.scope,
        F.col("driver").alias("driver_raw"),
        driver_label_series(F.col("driver")).alias("label"),
        F.col("volume").alias("total"),
    )


def driver_bars(source: MeasureSource) -> DataFrame:
    """:func:`driver_series` with the label wrapped for the axis."""
    return driver_series(source).select(
        *source.scope,
        "driver_raw", "label", wrap_label(F.col("label")).alias("label_wrapped"), "total"
    )
