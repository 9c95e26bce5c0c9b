"""Headline indicators.

A winner is the smallest ``(-total, key)``: equal totals always give the smallest key, whatever
order rows arrive in, which ``max_by`` does not promise. Each indicator is one row, or one per value of
the source's scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import safe_divide
from tripmill.functions.text import fill_text, strip, titlecase_card
from tripmill.operators import exact
from tripmill.operators.measures import FACETS, MeasureSource, grain_is


def _largest(key: str, among: Column) -> Column:
    entry = F.struct((-F.col("volume")).alias("rank"), F.col(key).alias("key"))
    return F.min(F.when(among & F.col(key).isNotNull(), entry))["key"]


def _smallest_positive(key: str, among: Column) -> Column:
    entry = F.struct(F.col("volume").alias("rank"), F.col(key).alias("key"))
    return F.min(F.when(among & F.col(key).isNotNull() & (F.col("volume") > 0), entry))["key"]


def _over(value: str, among: Column) -> Column:
    return F.coalesce(F.sum(F.when(among, F.col(value))), F.lit(0))


def _volume_over(among: Column) -> Column:
    parts = [F.col(c) for c in exact.LIMBS]
    return exact.total(exact.summed_limbs(parts, lambda part: F.when(among, part)))


def kpi_summary(source: MeasureSource) -> DataFrame:
    """All eight indicators in one row.

    Days, vehicles and drivers are grouped in one pass over the source, and the small result is
    reduced once more. Totals include trips without a time; active days do not.
    """
    on_day, on_vehicle, on_driver = (grain_is(*facet) for facet in FACETS)
    found = source.grains(*FACETS).groupBy(*source.scope).agg(
        _volume_over(on_day).alias("total"),
        _over("n_trips", on_day).alias("n_trips"),
        _largest("vehicle", on_vehicle).alias("vehicle"),
        _largest("driver", on_driver).alias("driver"),
        _largest("day", on_day).alias("best_day"),
        _smallest_positive("day", on_day).alias("worst_day"),
        F.count(F.when(on_day, F.col("day"))).alias("active_days"),
    )
    return found.select(
        *source.scope,
        "total",
        "n_trips",
        titlecase_card(F.col("vehicle")).alias("top_vehicle"),
        titlecase_card(F.col("driver")).alias("top_driver"),
        safe_divide(F.col("total"), F.col("active_days")).alias("mean_per_day"),
        "best_day",
        "worst_day",
        "active_days",
    )


def input_checks(source: MeasureSource) -> DataFrame:
    """What was repaired or left out on the way to the totals, as rows of ``check`` and ``n``.

    Counted in the pass that makes the measures, as measures themselves, so a task that runs twice does not
    count twice. A time or volume is unreadable if something was written, and missing if nothing was.
    """
    on_day, on_vehicle, on_driver = (grain_is(*facet) for facet in FACETS)

    def nameless(key: str) -> Column:
        return F.coalesce(strip(F.col(key)), F.lit("")) == ""

    counts = {
        "trips": _over("n_trips", on_day),
        "times_unreadable": _over("n_bad_times", on_day),
        "times_missing": _over("n_trips", on_day & F.col("day").isNull()) - _over("n_bad_times", on_day),
        "volumes_unreadable": _over("n_bad_volumes", on_day),
        "volumes_missing": _over("n_trips", on_day) - _over("n_loads", on_day) - _over("n_bad_volumes", on_day),
        "vehicles_without_name": _over("n_trips", on_vehicle & nameless("vehicle")),
        "drivers_without_name": _over("n_trips", on_driver & nameless("driver")),
    }
    found = source.grains(*FACETS).groupBy(*source.scope).agg(*[n.alias(check) for check, n in counts.items()])
    rows = [F.struct(F.lit(check).alias("check"), F.col(check).alias("n")) for check in counts]
    return found.select(*source.scope, F.inline(F.array(*rows)))


def _top(source: MeasureSource, key: str) -> DataFrame:
    return source.measures(key).groupBy(*source.scope).agg(_largest(key, F.lit(True)).alias(key))


def top_vehicle(source: MeasureSource) -> DataFrame:
    """The vehicle with the largest total, cased for the card; blank if no vehicle is named."""
    return _top(source, "vehicle").select(
        *source.scope,
        fill_text(F.col("vehicle")).alias("vehicle"),
        titlecase_card(F.col("vehicle")).alias("top_vehicle"),
    )


def top_driver(source: MeasureSource) -> DataFrame:
    """The raw driver name with the largest total, cased for the card."""
    return _top(source, "driver").select(
        *source.scope,
        fill_text(F.col("driver")).alias("driver"),
        titlecase_card(F.col("driver")).alias("top_driver"),
    )


def best_day(source: MeasureSource) -> DataFrame:
    """The day with the largest total, the earliest of equals; null without days."""
    return _top(source, "day").select(*source.scope, F.col("day").alias("best_day"))


def worst_positive_day(source: MeasureSource) -> DataFrame:
    """The day with the smallest total above zero, the earliest of equals."""
    found = _smallest_positive("day", F.lit(True))
    return source.measures("day").groupBy(*source.scope).agg(found.alias("worst_day"))


def days_positive(source: MeasureSource) -> DataFrame:
    """Days whose total is above zero."""
    days = source.measures("day").filter(F.col("day").isNotNull() & (F.col("volume") > 0))
    return days.select(*source.scope, "day", F.col("volume").alias("total"))


def active_days(source: MeasureSource) -> DataFrame:
    """Number of distinct days with any trip."""
    return source.measures("day").groupBy(*source.scope).agg(F.count("day").alias("active_days"))


def observed_period(source: MeasureSource) -> DataFrame:
    """Earliest and latest trip time in the data."""
    return source.measures().select(*source.scope, "first_time", "last_time")


def first_site(source: MeasureSource) -> DataFrame:
    """Site of the earliest trip; null without trips."""
    entry = F.struct(F.col("first_time").alias("time"), F.col("site").alias("site"))
    timed = F.when(F.col("first_time").isNotNull(), entry)
    return source.measures("site").groupBy(*source.scope).agg(F.min(timed)["site"].alias("site"))
