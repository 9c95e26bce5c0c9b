"""The additive measures every rollup is built from, and the things that supply them.

A measure frame holds some attributes (``day``, ``vehicle``, ``driver``, ``site``) and measures that can
be merged to any coarser grain; the volume carries the integer parts of its exact sum with it. :class:`Trips` computes them from trip rows,
:class:`TripCube` from rows already aggregated to a finer grain, :class:`TripSummary` from a staged
table that holds the few grains a report needs. All aggregate buffers are fixed-width, so they run
as hash aggregates with map-side combine: a key that holds a third of all rows arrives at the
shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.dates import time_or_null
from tripmill.functions.numbers import number_or_null
from tripmill.functions.text import fill_text
from tripmill.operators import exact
from tripmill.plans.staging import staged
from tripmill.schema import Roles, ensure_columns

COUNTS = ("n_trips", "n_loads", "n_positive", "n_bad_times", "n_bad_volumes")
MEASURES = (*COUNTS, "volume", *exact.LIMBS, "first_time", "last_time")
FACETS = (("day",), ("vehicle",), ("driver",))
REPORT_GRAINS = (("day", "vehicle"), ("day", "driver"), ("site",))


def _volume(limbs: Sequence[Column]) -> list[Column]:
    """The summed volume and the integer sums it is made of."""
    sums = exact.summed_limbs(limbs)
    return [exact.total(sums).alias("volume"), *[s.alias(n) for s, n in zip(sums, exact.LIMBS, strict=True)]]


def measurable(rows: DataFrame) -> DataFrame:
    """``rows`` with the parts of their volume as columns, ahead of a grouping that repeats rows."""
    return rows.withColumns(dict(zip(exact.LIMBS, exact.limbs(F.col("volume")), strict=True)))


def row_measures() -> list[Column]:
    """Measures of :func:`measurable` trip rows: all trips, trips with a numeric volume, trips with a volume above
    zero, times and volumes that are there but cannot be read, summed volume and the time span."""
    volume = F.col("volume")
    return [
        F.count(F.lit(1)).alias("n_trips"),
        F.count(volume).alias("n_loads"),
        F.count(F.when(volume > 0, 1)).alias("n_positive"),
        F.count(F.when(F.col("bad_time"), 1)).alias("n_bad_times"),
        F.count(F.when(F.col("bad_volume"), 1)).alias("n_bad_volumes"),
        *_volume([F.col(c) for c in exact.LIMBS]),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    ]


def load_measures() -> dict[str, Column]:
    """Measures of each :func:`measurable` trip row alone: those of a group of one."""
    volume = F.col("volume")

    def count(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    return {
        "n_trips": F.lit(1).cast("bigint"),
        "n_loads": count(volume.isNotNull()),
        "n_positive": count(volume > 0),
        "n_bad_times": count(F.col("bad_time")),
        "n_bad_volumes": count(F.col("bad_volume")),
        "volume": exact.total([F.col(c) for c in exact.LIMBS]),
        "first_time": F.col("time"),
        "last_time": F.col("time"),
    }


def unreadable(raw: Column, value: Column) -> Column:
    """True where something was written that has no value."""
    return raw.isNotNull() & value.isNull()


def merged_measures() -> list[Column]:
    """The same measures, from rows that already hold them."""
    return [
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
        *_volume([F.col(c) for c in exact.LIMBS]),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    ]


def grain_name(keys: Sequence[str]) -> str:
    return "_".join(keys)


def grain_is(*keys: str) -> Column:
    """True on the rows of :meth:`MeasureSource.grains` grouped by ``keys``."""
    return F.col("grain") == grain_name(keys)


class MeasureSource(Protocol):
    """Anything rollups can be computed from.

    ``scope`` names columns that every result is grouped by besides its keys, and carries: with a plant
    as scope, each rollup, indicator and page number is that of one plant.
    """

    scope: tuple[str, ...]

    def measures(self, *keys: str, blank: bool = False, days: bool = False) -> DataFrame:
        """Measures grouped by ``keys``. Null keys form a group, or with ``blank`` join the group of
        the empty text. With ``days``, which needs the key ``month``, also the set of days with a load
        above zero."""

    def grains(self, *sets: Sequence[str]) -> DataFrame:
        """Measures grouped by several key sets, each told by ``grain``, in one pass if the source
        has to be read whole."""


#: Days of a month with a load above zero, one bit each; sets of one month merge by ``bit_or``.
DAY_SET = "positive_days"


def _day_columns(positive: Column) -> dict[str, Column]:
    """The month of ``day``, and the set that holds the day alone, null where nothing was loaded."""
    return {"month": F.trunc("day", "month"), DAY_SET: F.when(positive, F.expr("shiftleft(1, dayofmonth(day) - 1)"))}


def n_days(sets: Column) -> Column:
    return F.coalesce(F.bit_count(sets), F.lit(0))


def _with_days(aggregates: list[Column], keys: Sequence[str], days: bool) -> list[Column]:
    if not days:
        return aggregates
    if "month" not in keys:
        raise ValueError("a set of days belongs to a month")
    return [*aggregates, F.bit_or(DAY_SET).alias(DAY_SET)]


def _group(
    rows: DataFrame, keys: Sequence[str], blank: bool, aggregates: list[Column], scope: Sequence[str]
) -> DataFrame:
    by = [fill_text(F.col(k)).alias(k) if blank else F.col(k) for k in keys]
    return rows.groupBy(*scope, *by).agg(*aggregates)


def _group_sets(
    rows: DataFrame, sets: Sequence[Sequence[str]], aggregates: list[Column], scope: Sequence[str]
) -> DataFrame:
    attributes = list(dict.fromkeys([*scope, *(a for keys in sets for a in keys)]))
    grouped = rows.groupingSets(
        [[F.col(a) for a in (*scope, *keys)] for keys in sets], *[F.col(a) for a in attributes]
    )
    found = grouped.agg(F.grouping_id().alias("_left_out"), *aggregates)

    def left_out(keys: Sequence[str]) -> int:
        return int("".join("0" if a in scope or a in keys else "1" for a in attributes), 2)

    names = [F.when(F.col("_left_out") == left_out(s), grain_name(s)) for s in sets]
    return found.select(F.coalesce(*names).alias("grain"), *attributes, *MEASURES)


class Trips:
    """Trip rows: any table with the columns named by ``roles``; absent columns count as null
    (a wholly absent volume as zero)."""

    def __init__(self, df: DataFrame, roles: Roles = Roles(), scope: Sequence[str] = ()):
        self.scope = tuple(scope)
        text = (roles.vehicle, roles.driver, roles.site)
        absent = {c: F.lit(None).cast("string") for c in text}
        absent[roles.time] = F.lit(None).cast("timestamp_ntz")
        absent[roles.volume] = F.lit(0.0)
        full = ensure_columns(df, absent)
        time, volume = time_or_null(full, roles.time), number_or_null(full, roles.volume)
        self.rows = full.select(
            time.alias("time"),
            F.to_date(time).alias("day"),
            F.col(roles.vehicle).cast("string").alias("vehicle"),
            F.col(roles.driver).cast("string").alias("driver"),
            volume.alias("volume"),
            unreadable(F.col(roles.time), time).alias("bad_time"),
            unreadable(F.col(roles.volume), volume).alias("bad_volume"),
            F.col(roles.site).cast("string").alias("site"),
            *[F.col(c) for c in self.scope],
        )

    def measures(self, *keys: str, blank: bool = False, days: bool = False) -> DataFrame:
        rows = self.rows.withColumns(_day_columns(F.col("volume") > 0)) if "month" in keys else self.rows
        return _group(measurable(rows), keys, blank, _with_days(row_measures(), keys, days), self.scope)

    def grains(self, *sets: Sequence[str]) -> DataFrame:
        return _group_sets(measurable(self.rows), sets, row_measures(), self.scope)


class TripCube:
    """Measures at a fine grain, with the attributes that later rollups need.

    Rows by day have sets of days too; rows by month have those they were stored with.
    """

    def __init__(self, rows: DataFrame, scope: Sequence[str] = ()):
        self.scope = tuple(scope)
        by_month = "month" in rows.columns or "day" not in rows.columns
        self.rows = rows if by_month else rows.withColumns(_day_columns(F.col("n_positive") > 0))

    def measures(self, *keys: str, blank: bool = False, days: bool = False) -> DataFrame:
        return _group(self.rows, keys, blank, _with_days(merged_measures(), keys, days), self.scope)

    def grains(self, *sets: Sequence[str]) -> DataFrame:
        return _group_sets(self.rows, sets, merged_measures(), self.scope)


class TripSummary:
    """The grains a report needs, staged in two steps.

    Trips are read in one pass that groups them by day and vehicle, by day and driver, and by site.
    ``is_staged`` tells sections that rollups of it need no staging of their own. From that table the
    totals per day, vehicle and driver are staged once more, since most sections
    need nothing finer. Both tables are laid out by grain, so a rollup reads the rows of one grain.
    """

    is_staged = True

    def __init__(self, source: MeasureSource):
        self.scope = source.scope
        self.fine = staged(source.grains(*REPORT_GRAINS), partition_by="grain")
        totals = [self._total(*facet) for facet in FACETS]
        self.totals = staged(reduce(DataFrame.unionByName, totals), partition_by="grain")

    def _fine_rows(self, keys: Sequence[str]) -> DataFrame:
        for grain in REPORT_GRAINS:
            if set(keys) <= set(grain):
                return self.fine.filter(grain_is(*grain))
        raise ValueError(f"no staged grain holds {', '.join(keys)}")

    def _total(self, key: str) -> DataFrame:
        """Totals of one facet, in columns for all of them."""
        grouped = _group(self._fine_rows([key]), [key], False, merged_measures(), self.scope)
        kinds = {f.name: f.dataType for f in self.fine.schema}
        columns = [
            F.col(a) if a == key else F.lit(None).cast(kinds[a]).alias(a) for (a,) in FACETS
        ]
        return grouped.select(F.lit(key).alias("grain"), *self.scope, *columns, *MEASURES)

    def measures(self, *keys: str, blank: bool = False, days: bool = False) -> DataFrame:
        if "month" in keys:
            by_day = [k for k in keys if k != "month"] + ["day"]
            return TripCube(self._fine_rows(by_day), self.scope).measures(*keys, blank=blank, days=days)
        facet = keys or FACETS[0]
        whole = facet in FACETS
        rows = self.totals.filter(grain_is(*facet)) if whole else self._fine_rows(keys)
        return _group(rows, keys, blank, merged_measures(), self.scope)

    def grains(self, *sets: Sequence[str]) -> DataFrame:
        if not all(tuple(keys) in FACETS for keys in sets):
            raise ValueError("a summary holds whole grains per day, vehicle and driver only")
        return self.totals.filter(F.col("grain").isin(*[grain_name(keys) for keys in sets]))
