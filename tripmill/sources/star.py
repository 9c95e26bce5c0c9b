"""Trips from the star tables: loads joined with vehicle tag, reader, site and driver.

Bridge tables are joined with what they lead to first (reader with site, driver entry with
employee), so the loads are matched three times instead of five. No side is broadcast by hand:
Spark broadcasts a side whose size it knows to be under ``spark.sql.autoBroadcastJoinThreshold``,
and otherwise shuffles; adaptive execution splits a shuffled key that is too large. Where tags, readers
or drivers are known to be unequal, :meth:`StarTables.balanced` looks for the heavy ones once, and the
joins spread these whatever their size in bytes.

:meth:`StarTables.cube` is the other way: it aggregates the loads by their id columns and day before
any join. That pays where the same truck, reader and driver meet often in a day, as they do in a plant,
and where a report needs several rollups of one selection. Where most loads have a combination of their own,
which a sketch of the combinations tells beforehand, they are joined first: groups of one load would only make
them wider, in the tables of every grouping task and in the sorts of the joins.

With the cube, attributes are attached to the few combinations of tag, reader, driver and day, and a
tag or driver that owns a third of all loads is one of them. A repeated dimension key multiplies the
aggregated row just as it multiplies the loads behind it, so totals are those of the plain join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.dates import instant, time_or_null
from tripmill.functions.numbers import number_or_null
from tripmill.operators.heavy import HeavyKeys, heavy_keys, spread_join
from tripmill.operators.measures import MEASURES, TripCube, load_measures, measurable, row_measures, unreadable
from tripmill.schema import Roles
from tripmill.sources.partitions import DayPartitions

#: Values that the second join key of rows without a driver id takes.
NULL_SPREAD = 4096


@dataclass(frozen=True)
class StarColumns:
    """Column names of the six tables, and how the loads are partitioned by date, if they are."""

    time: str = "time"
    volume: str = "volume_descarregado"
    tag: str = "user_id_device"
    reader: str = "device_id"
    driver: str = "motorista"
    plant: str = "codigo_planta"
    vehicle_tag: str = "user_id_sensor"
    vehicle_name: str = "prefixo_veiculo"
    reader_id: str = "device_id"
    reader_site: str = "local_instalacao"
    site_id: str = "id"
    site_name: str = "desc_obra"
    driver_id: str = "id"
    driver_employee: str = "id_motorista"
    employee_id: str = "id"
    employee_name: str = "nome"
    partitions: DayPartitions | None = None


def at_site(loads: DataFrame, site: int, plant: str = "codigo_planta") -> DataFrame:
    """Loads whose own plant code is ``site``."""
    return loads.filter(F.col(plant) == site)


def within_period(
    loads: DataFrame,
    start: str | datetime | Column | None = None,
    end: str | datetime | Column | None = None,
    time: str = "time",
    partitions: DayPartitions | None = None,
) -> DataFrame:
    """Loads from ``start`` and until ``end``, both included; each bound holds on its own.

    A time that cannot be read as one is in no period. Of a table partitioned by date, ``partitions``
    keeps the scan to the dates of the period.
    """
    value = time_or_null(loads, time)
    if partitions is not None:
        loads = partitions.within(loads, start, end, time)
    if start is not None:
        loads = loads.filter(value >= instant(start))
    if end is not None:
        loads = loads.filter(value <= instant(end))
    return loads


def _repeats(loads: DataFrame, by: Sequence[str]) -> bool:
    """Whether grouping by these columns leaves at most half as many rows, by a sketch in one pass.

    It decides only when they are grouped. A wrong guess changes no result.
    """
    found = loads.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*by))).first()
    return 2 * found[1] <= found[0]


@dataclass(frozen=True)
class StarTables:
    """The load facts and their dimensions.

    ``unique_drivers`` states that driver and employee ids are primary keys. The left join then
    neither drops nor repeats loads, and is skipped where no driver is asked for. It is taken on
    trust; :meth:`key_check` tells whether it holds.
    """

    loads: DataFrame
    vehicles: DataFrame
    readers: DataFrame
    sites: DataFrame
    drivers: DataFrame
    employees: DataFrame
    columns: StarColumns = field(default_factory=StarColumns)
    unique_drivers: bool = False
    heavy: Mapping[str, HeavyKeys] = field(default_factory=dict)

    def balanced(
        self,
        site: int | None = None,
        start: str | datetime | Column | None = None,
        end: str | datetime | Column | None = None,
    ) -> StarTables:
        """The same tables, with the tags, readers and drivers found that have very many loads.

        They are looked for in one pass over the selected loads, and their joins are spread from then on;
        loads without a driver are one such key. Results are the same for any selection.
        """
        c = self.columns
        loads = self.selected_loads(site, start, end)
        return replace(self, heavy=heavy_keys(loads, list(dict.fromkeys([c.tag, c.reader, c.driver]))))

    def _spread_by(self, rows: DataFrame) -> list[str]:
        """Columns that a report reads anyway; others would have to be scanned for the hash alone."""
        c = self.columns
        return [n for n in (c.tag, c.reader, c.time, c.volume, "day", "volume") if n in rows.columns]

    def with_vehicle(self, rows: DataFrame) -> DataFrame:
        """Add ``vehicle``; rows without a matching tag are dropped."""
        c = self.columns
        tags = self.vehicles.select(
            F.col(c.vehicle_tag).alias("_tag"), F.col(c.vehicle_name).alias("vehicle")
        )
        by = self._spread_by(rows)
        return spread_join(rows, tags, [(c.tag, "_tag")], self.heavy.get(c.tag), by).drop("_tag")

    def with_site(self, rows: DataFrame) -> DataFrame:
        """Add ``site``, the place the reader is installed at; unmatched rows are dropped."""
        c = self.columns
        places = self.sites.select(
            F.col(c.site_id).alias("_place"), F.col(c.site_name).alias("site")
        )
        readers = self.readers.select(
            F.col(c.reader_id).alias("_reader"), F.col(c.reader_site).alias("_installed")
        )
        located = readers.join(places, F.col("_installed") == F.col("_place"))
        located = located.select("_reader", "site")
        by = self._spread_by(rows)
        return spread_join(rows, located, [(c.reader, "_reader")], self.heavy.get(c.reader), by).drop("_reader")

    def with_driver(self, rows: DataFrame) -> DataFrame:
        """Add ``driver``, null where no entry or no employee matches.

        Rows without a driver id match nothing. A second join key, 0 for all others and for all
        entries with an id, spreads them evenly in place of hashing all of them to one partition. It makes
        a broadcast join about a quarter slower; after :meth:`balanced`, only drivers found heavy, or none
        if many loads have none, get one.
        """
        c = self.columns
        names = self.employees.select(
            F.col(c.employee_id).alias("_employee"), F.col(c.employee_name).alias("driver")
        )
        entries = self.drivers.select(
            F.col(c.driver_id).alias("_entry"), F.col(c.driver_employee).alias("_of")
        )
        named = entries.join(names, F.col("_of") == F.col("_employee"), "left")
        by = self._spread_by(rows)
        if c.driver in self.heavy:
            known = named.select("_entry", "driver")
            return spread_join(rows, known, [(c.driver, "_entry")], self.heavy[c.driver], by, "left").drop("_entry")
        named = named.select("_entry", F.col("_entry").isNull().cast("int").alias("_zero"), "driver")
        spread = F.pmod(F.xxhash64(*by, F.lit(0)), F.lit(NULL_SPREAD)).cast("int")
        salted = rows.withColumn("_salt", F.when(F.col(c.driver).isNull(), spread).otherwise(0))
        matched = (F.col(c.driver) == F.col("_entry")) & (F.col("_salt") == F.col("_zero"))
        return salted.join(named, matched, "left").drop("_entry", "_zero", "_salt")

    def key_check(self) -> DataFrame:
        """Rows, distinct keys and repeated keys of each dimension, null keys not counted."""
        c = self.columns
        dimensions = {
            "vehicles": (self.vehicles, c.vehicle_tag),
            "readers": (self.readers, c.reader_id),
            "sites": (self.sites, c.site_id),
            "drivers": (self.drivers, c.driver_id),
            "employees": (self.employees, c.employee_id),
        }
        checks = [
            rows.where(F.col(key).isNotNull())
            .groupBy(F.col(key).cast("string"))
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.lit(name).alias("dimension"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                F.count(F.lit(1)).alias("n_keys"),
                F.count(F.when(F.col("n") > 1, 1)).alias("n_repeated"),
            )
            for name, (rows, key) in dimensions.items()
        ]
        return reduce(DataFrame.unionByName, checks)

    def match_check(
        self,
        site: int | None = None,
        start: str | datetime | Column | None = None,
        end: str | datetime | Column | None = None,
    ) -> DataFrame:
        """Selected loads without an id, and with one that no dimension row has: those the joins drop, or
        leave without a driver. Loads are read once and reach the joins as counts per id."""
        c = self.columns
        dimensions = {
            "vehicles": (c.tag, self.vehicles, c.vehicle_tag),
            "readers": (c.reader, self.readers, c.reader_id),
            "drivers": (c.driver, self.drivers, c.driver_id),
        }
        kinds = F.array(
            *[F.struct(F.lit(n).alias("dimension"), F.col(k).cast("string").alias("id")) for n, (k, *_) in dimensions.items()]
        )
        counted = self.selected_loads(site, start, end).select(F.inline(kinds)).groupBy("dimension", "id")
        counted = counted.agg(F.count(F.lit(1)).alias("n"))
        known = [
            rows.select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("id"), F.lit(True).alias("found"))
            for name, (_, rows, key) in dimensions.items()
        ]
        matched = counted.join(reduce(DataFrame.unionByName, known).distinct(), ["dimension", "id"], "left")
        missing = F.col("id").isNull()
        return matched.groupBy("dimension").agg(
            F.sum("n").alias("n_loads"),
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("n_without_id"),
            F.coalesce(F.sum(F.when(~missing & F.col("found").isNull(), F.col("n"))), F.lit(0)).alias("n_unmatched"),
        )

    def selected_loads(
        self,
        site: int | None = None,
        start: str | datetime | Column | None = None,
        end: str | datetime | Column | None = None,
    ) -> DataFrame:
        """The loads of a plant and period; without arguments, all of them."""
        c = self.columns
        rows = self.loads
        if site is not None:
            rows = at_site(rows, site, c.plant)
        return within_period(rows, start, end, c.time, c.partitions)

    def extract(
        self,
        site: int | None = None,
        start: str | datetime | Column | None = None,
        end: str | datetime | Column | None = None,
        *,
        names: Roles = Roles(),
        with_driver: bool = True,
        ordered: bool = True,
        tie_break: Sequence[str] = (),
    ) -> DataFrame:
        """The trip rows, in time order.

        Trips of one instant are further ordered by the other columns and by ``tie_break`` (key
        columns of the loads), so that a crowded instant is spread over several sort partitions.
        ``with_driver=False`` leaves the driver null and, with unique drivers, skips its joins.
        """
        c = self.columns
        rows = self.with_site(self.with_vehicle(self.selected_loads(site, start, end)))
        if with_driver or not self.unique_drivers:
            rows = self.with_driver(rows)
        driver = F.col("driver") if with_driver else F.lit(None).cast("string")
        wanted = [
            F.col(c.time).alias(names.time),
            F.col("vehicle").alias(names.vehicle),
            driver.alias(names.driver),
            F.col(c.volume).alias(names.volume),
            F.col("site").alias(names.site),
        ]
        if not ordered:
            return rows.select(*wanted)
        trips = [names.time, names.vehicle, names.driver, names.volume, names.site]
        ties = [F.col(t).alias(f"_tie{i}") for i, t in enumerate(tie_break)]
        keyed = rows.select(*wanted, *ties)
        return keyed.orderBy(*trips, *[f"_tie{i}" for i in range(len(ties))]).select(*trips)

    def cube(
        self,
        site: int | None = None,
        start: str | datetime | Column | None = None,
        end: str | datetime | Column | None = None,
        *,
        keys: Sequence[str] = ("day", "vehicle", "driver", "site"),
        by_plant: bool = False,
    ) -> TripCube:
        """Measures of the selected loads with the attributes in ``keys``, aggregated before the
        joins if that leaves at most half as many rows; other loads are joined as the narrow rows they
        are, and measured one by one. With ``by_plant`` they are kept apart by the loads' own plant code, the cube's scope;
        loads without one are left out."""
        c = self.columns
        rows = self.selected_loads(site, start, end)
        need_driver = "driver" in keys or not self.unique_drivers
        ids = [c.tag, c.reader] + ([c.driver] if need_driver else [])
        time, volume = time_or_null(rows, c.time), number_or_null(rows, c.volume)
        scope = ("plant",) if by_plant else ()
        if by_plant:
            rows = rows.filter(F.col(c.plant).isNotNull())
        canonical = rows.select(
            *ids,
            *[F.col(c.plant).alias(s) for s in scope],
            time.alias("time"),
            volume.alias("volume"),
            unreadable(F.col(c.time), time).alias("bad_time"),
            unreadable(F.col(c.volume), volume).alias("bad_volume"),
            F.to_date(time).alias("day"),
        )
        by = [*ids, *scope, *(["day"] if "day" in keys else [])]
        repeated = _repeats(canonical, by)
        cube = measurable(canonical).groupBy(*by).agg(*row_measures()) if repeated else canonical
        cube = self.with_site(self.with_vehicle(cube))
        if need_driver:
            cube = self.with_driver(cube)
        if not repeated:
            cube = measurable(cube).withColumns(load_measures())
        return TripCube(cube.select(*scope, *keys, *MEASURES), scope)
