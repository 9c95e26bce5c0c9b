"""Per-day, per-vehicle and per-driver rollups.

Each rollup carries the unrounded total (``volume``, the sort key) beside the rounded columns that
the display tables show. Null and blank keys are treated differently by each of them, as documented
on the functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import round2, safe_divide
from tripmill.functions.text import driver_label_table, strip
from tripmill.operators.measures import DAY_SET, MeasureSource, merged_measures, n_days
from tripmill.operators.pages import with_pages
from tripmill.plans.staging import staged

#: Names in a chunk of a day's vehicle list.
CHUNK = 100


def _rounded(count: str) -> list[Column]:
    volume = F.col("volume")
    return [
        round2(volume).alias("total"),
        round2(safe_divide(volume, F.col(count))).alias("mean_load"),
    ]


def vehicle_list(name: Column) -> Column:
    """Aggregate: distinct non-blank names, in case-insensitive order, comma separated."""
    entry = F.struct(F.lower(name).alias("folded"), name.alias("name"))
    entries = F.array_sort(F.collect_set(F.when(name != "", entry)))
    return F.array_join(F.transform(entries, lambda e: e["name"]), ", ")


def daily_rollup(source: MeasureSource) -> DataFrame:
    """One row per day: trips, total, mean over all trips, vehicles seen, first and last trip.

    The list holds every vehicle of a day in one text; :func:`daily_vehicles` has them as rows, and
    :func:`daily_vehicle_chunks` in texts of bounded length, for sources with more vehicles than a text
    should name. Rows without a time are left out; a volume that
    is no number counts as a trip of zero. Rows are combined per (day, vehicle) first, so the list of a
    day is collected from one row per vehicle.
    """
    per_vehicle = source.measures("day", "vehicle").filter(F.col("day").isNotNull())
    stripped = per_vehicle.withColumn("vehicle", strip(F.col("vehicle")))
    days = stripped.groupBy(*source.scope, "day").agg(
        *merged_measures(), vehicle_list(F.col("vehicle")).alias("vehicles")
    )
    return days.select("*", *_rounded("n_trips"))


def daily_vehicles(source: MeasureSource) -> DataFrame:
    """One row per day and vehicle seen, with the trips: the daily list at any number of vehicles."""
    per_vehicle = source.measures("day", "vehicle").filter(F.col("day").isNotNull())
    named = per_vehicle.withColumn("vehicle", strip(F.col("vehicle"))).filter(F.col("vehicle") != "")
    return named.groupBy(*source.scope, "day", "vehicle").agg(F.sum("n_trips").alias("n_trips"))


def daily_vehicle_chunks(source: MeasureSource, size: int = CHUNK) -> DataFrame:
    """The list of each day in numbered chunks of ``size`` names: ``day, chunk, n_vehicles, vehicles``.

    Names have the order of the list, so the chunks of a day joined by comma are the list. No row and no
    buffer holds more than one chunk, however many vehicles a day has; names are ranked in even buckets.
    """
    names = daily_vehicles(source).select(*source.scope, "day", "vehicle")
    scope = [*source.scope, "day"]
    placed = with_pages(staged(names), [F.lower("vehicle"), F.col("vehicle")], size, scope=scope)
    entries = F.array_sort(F.collect_list(F.struct("row_in_page", "vehicle")))
    return placed.groupBy(*scope, F.col("page_no").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_vehicles"), F.array_join(entries["vehicle"], ", ").alias("vehicles")
    )


def daily_vehicle_lists(source: MeasureSource) -> DataFrame:
    """The vehicles seen on each day."""
    return daily_rollup(source).select(*source.scope, "day", "vehicles")


def vehicle_rollup(source: MeasureSource) -> DataFrame:
    """One row per vehicle; vehicles without a name share the blank one.

    Trips and mean cover only the loads with a numeric volume.
    """
    vehicles = source.measures("vehicle", blank=True)
    return vehicles.select("*", *_rounded("n_loads"))


def driver_months(source: MeasureSource) -> DataFrame:
    """Totals per raw driver name and month, with the set of days that have a load above zero.

    They can be stored and added up later: ``driver_rollup(TripCube(...))`` over the union of several
    periods, whole months or parts of them, is the rollup of all their trips.
    """
    return source.measures("driver", "month", days=True)


def driver_rollup(source: MeasureSource) -> DataFrame:
    """One row per driver label, with the days on which the driver had a load above zero.

    Rows are combined per raw name and month first, days as bits of one number; casing the label is the
    costly part and runs on that smaller frame. Names that share a label are brought together once, and
    their sets of days are merged before they are counted, so no day counts twice.
    """
    labelled = driver_months(source).withColumn("driver", driver_label_table(F.col("driver")))
    # Both groupings below find their rows together already.
    per_month = labelled.repartition(*source.scope, "driver").groupBy(*source.scope, "driver", "month")
    merged = per_month.agg(*merged_measures(), F.bit_or(DAY_SET).alias(DAY_SET))
    drivers = merged.groupBy(*source.scope, "driver").agg(*merged_measures(), F.sum(n_days(F.col(DAY_SET))).alias("active_days"))
    # The mean per day divides the rounded total, and is rounded again.
    mean_per_day = round2(safe_divide(F.col("total"), F.col("active_days")))
    return drivers.select("*", *_rounded("n_loads")).withColumn("mean_per_day", mean_per_day)


def driver_active_days(source: MeasureSource) -> DataFrame:
    """Days with a load above zero, per driver label that has such a load."""
    loaded = driver_rollup(source).filter(F.col("n_positive") > 0)
    return loaded.select(*source.scope, "driver", "active_days")


def largest_first(rollup: DataFrame, key: str) -> DataFrame:
    """Order by unrounded total, largest first; equal totals by key."""
    return rollup.orderBy(F.desc("volume"), key)
