"""Empty, tied, missing and repeated input."""

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from compare import plan
from tripmill import Cover, Roles, StarTables, Trips, build_report, ensure_columns
from tripmill.operators import kpis, rollups, series
from tripmill.plans import report
from tripmill.schema import card_defaults, table_defaults

EMPTY_KPIS = {
    "total": 0.0,
    "n_trips": 0,
    "top_vehicle": "",
    "top_driver": "",
    "mean_per_day": 0.0,
    "best_day": None,
    "worst_day": None,
    "active_days": 0,
}


def test_no_trips(spark):
    sites = spark.createDataFrame([], "id int, desc_obra string")
    sections = build_report(fx.trips_of(spark, []), Cover(sites, 7))
    (header,) = sections["header"].collect()
    assert (header.company, header.brand, header.period) == ("Obra 7", "B", "")
    cards = [r.value for r in sections["kpi_cards"].orderBy("position").collect()]
    assert cards == ["0,00", "0", "-", "-", "0,00", "-\n-"]
    for name in ("daily_series", "daily_table", "vehicle_table", "driver_table", "driver_series"):
        assert sections[name].collect() == []
    assert {r.section: (r.n_rows, r.message) for r in sections["status"].collect()} == {
        "daily_series": (0, report.NO_POINTS),
        "daily_table": (0, report.NO_ROWS),
        "vehicle_series": (0, report.NO_POINTS),
        "vehicle_table": (0, report.NO_ROWS),
        "driver_series": (0, report.NO_POINTS),
        "driver_table": (0, report.NO_ROWS),
    }
    assert {r.caption for r in sections["captions"].collect()} == {""}
    (row,) = kpis.kpi_summary(fx.trips_of(spark, [])).collect()
    assert row.asDict() == EMPTY_KPIS


def test_all_null(spark):
    trips = fx.trips_of(spark, [(None, None, None, None, None)] * 3)
    (row,) = kpis.kpi_summary(trips).collect()
    assert row.asDict() == EMPTY_KPIS | {"n_trips": 3}
    assert fx.tuples(rollups.daily_rollup(trips)) == []
    (vehicle,) = rollups.vehicle_rollup(trips).collect()
    assert (vehicle.vehicle, vehicle.n_loads, vehicle.total, vehicle.mean_load) == ("", 0, 0.0, 0.0)
    (driver,) = rollups.driver_rollup(trips).collect()
    assert (driver.driver, driver.active_days, driver.mean_per_day) == ("Não Definido", 0, 0.0)
    assert fx.tuples(series.vehicle_series(trips)) == []
    status = {r.section: (r.n_rows, r.message) for r in report.section_status(trips).collect()}
    assert status["daily_table"] == (0, report.NO_ROWS)
    assert status["vehicle_series"] == (0, None)
    assert status["vehicle_table"] == (1, None)


def test_one_trip(spark):
    trips = fx.trips_of(spark, [("2025-09-01 06:00:00", "A", "ana", "3", "x")])
    (row,) = kpis.kpi_summary(trips).collect()
    assert (row.total, row.best_day, row.worst_day) == (3.0, fx.day(1), fx.day(1))


def test_ties_go_to_the_smallest_key(spark):
    rows = [(f"2025-09-0{d} 06:00:00", v, n, "5", "x") for d, v, n in ((3, "B", "rui"), (2, "C", "ana"), (4, "A", "zé"))]
    (row,) = kpis.kpi_summary(fx.trips_of(spark, rows)).collect()
    assert (row.top_vehicle, row.top_driver) == ("A", "Ana")
    assert (row.best_day, row.worst_day) == (fx.day(2), fx.day(2))
    assert [r[0] for r in series.vehicle_series(fx.trips_of(spark, rows)).collect()] == ["A", "B", "C"]


def test_daily_and_vehicle_totals_agree(spark):
    trips = fx.trips_of(
        spark, [(f"2025-09-0{1 + i % 9} 06:00:00", f"V{i % 7}", f"d{i % 5}", str(i), "x") for i in range(200)]
    )
    totals = [s(trips).agg(F.sum("total")).first()[0] for s in (series.daily_series, series.vehicle_series, series.driver_series)]
    assert totals == [19900.0] * 3


@pytest.mark.parametrize("missing", ["time", "vehicle", "driver", "volume", "site"])
def test_missing_column(spark, missing):
    trips = Trips(fx.spoiled_frame(spark).drop(missing), Roles.plain())
    (row,) = kpis.kpi_summary(trips).collect()
    assert row.n_trips == 12
    assert row.total == (0.0 if missing == "volume" else 114.75)
    assert row.active_days == (0 if missing == "time" else 5)
    assert row.top_vehicle == {"vehicle": "", "volume": ""}.get(missing, "Trk-200")
    days = rollups.daily_rollup(trips).collect()
    assert len(days) == (0 if missing == "time" else 5)
    vehicles = {r.vehicle: r.n_loads for r in rollups.vehicle_rollup(trips).collect()}
    if missing == "volume":
        assert vehicles["TRK-100"] == 3
    drivers = {r.driver for r in rollups.driver_rollup(trips).collect()}
    assert (drivers == {"Não Definido"}) == (missing == "driver")


def test_ensure_columns(spark):
    partial = spark.createDataFrame([("a",)], "nome string")
    (row,) = ensure_columns(partial, table_defaults()).collect()
    assert row.asDict() == {"nome": "a", "time": "", "desc_obra": "", "prefixo_veiculo": "", "volume_descarregado": 0.0}
    (row,) = ensure_columns(partial, card_defaults()).collect()
    assert row.asDict() == {"nome": "a", "time": None, "volume_descarregado": None, "prefixo_veiculo": None}
    whole = ensure_columns(partial, table_defaults())
    assert ensure_columns(whole, table_defaults()).columns == whole.columns


def star(spark, **changes):
    tables = {
        "loads": spark.createDataFrame(
            [
                ("2025-09-01 06:00:00", 10.0, 1, 100, 7, 41),
                ("2025-09-01 07:00:00", 20.0, 2, 100, None, 41),
                ("2025-09-02 06:00:00", 30.0, 1, 200, 8, 41),
                ("2025-09-02 07:00:00", 40.0, 9, 100, 7, 41),
                ("2025-09-02 08:00:00", 50.0, 1, 900, 7, 41),
                ("2025-09-02 09:00:00", 60.0, 1, 100, 7, 42),
                ("2025-09-30 23:59:59.5", 70.0, 1, 100, 7, 41),
            ],
            "time string, volume_descarregado double, user_id_device long, device_id long, motorista long, codigo_planta int",
        ).withColumn("time", F.col("time").cast("timestamp_ntz")),
        "vehicles": spark.createDataFrame([(1, "TRK-1"), (2, "TRK-2")], "user_id_sensor long, prefixo_veiculo string"),
        "readers": spark.createDataFrame([(100, 41), (200, 42)], "device_id long, local_instalacao int"),
        "sites": spark.createDataFrame([(41, "Norte"), (42, "Sul")], "id int, desc_obra string"),
        "drivers": spark.createDataFrame([(7, 70), (8, 80)], "id long, id_motorista long"),
        "employees": spark.createDataFrame([(70, "ana")], "id long, nome string"),
    }
    return StarTables(**(tables | changes))


PERIOD = ("2025-09-01 00:00:00", "2025-09-30 23:59:59")


def test_extract(spark):
    found = star(spark).extract(41, *PERIOD).collect()
    assert [(r.prefixo_veiculo, r.nome, r.volume_descarregado, r.desc_obra) for r in found] == [
        ("TRK-1", "ana", 10.0, "Norte"),
        ("TRK-2", None, 20.0, "Norte"),
        ("TRK-1", None, 30.0, "Sul"),
    ]


@pytest.mark.parametrize("copies", [1, 2])
def test_repeated_dimension_keys_multiply_trips(spark, copies):
    def repeat(df):
        return df if copies == 1 else df.unionByName(df)

    plain = star(spark)
    tables = star(
        spark, vehicles=repeat(plain.vehicles), readers=repeat(plain.readers), employees=repeat(plain.employees)
    )
    trips = Trips(tables.extract(41, *PERIOD))
    cube = tables.cube(41, *PERIOD)
    assert kpis.kpi_summary(trips).collect() == kpis.kpi_summary(cube).collect()
    by_driver = {r.driver_raw: r.total for r in series.driver_series(cube).collect()}
    assert by_driver == {"ana": 10.0 * copies**3, "": 50.0 * copies**2}
    for rollup, key in ((rollups.daily_rollup, "day"), (rollups.vehicle_rollup, "vehicle"), (rollups.driver_rollup, "driver")):
        assert rollup(trips).orderBy(key).collect() == rollup(cube).orderBy(key).collect()


@pytest.mark.parametrize("times", [1, 3])
def test_cube_groups_before_the_joins_only_what_repeats(spark, times):
    odd = spark.createDataFrame(
        [
            ("2025-09-03 06:00:00", None, 1, 100, 7, 41),
            (None, 5.5, 2, 100, 7, 41),
            ("2025-09-04 06:00:00", -1.25, 2, 200, 8, 41),
            ("2025-09-04 07:00:00", 1e12, None, None, None, None),
            ("2025-09-05 07:00:00", 0.1, 1, 100, 7, 41),
        ],
        "time string, volume_descarregado double, user_id_device long, device_id long, motorista long, codigo_planta int",
    ).withColumn("time", F.col("time").cast("timestamp_ntz"))
    loads = star(spark).loads.unionByName(odd)
    for _ in range(1, times):
        loads = loads.unionByName(star(spark).loads).unionByName(odd)
    tables = star(spark, loads=loads)
    trips, cube = Trips(tables.extract()), tables.cube()
    assert plan(cube.rows).count("HashAggregate") == (0 if times == 1 else 2)
    assert kpis.kpi_summary(trips).collect() == kpis.kpi_summary(cube).collect()
    assert kpis.input_checks(trips).collect() == kpis.input_checks(cube).collect()
    for rollup, key in ((rollups.daily_rollup, "day"), (rollups.vehicle_rollup, "vehicle"), (rollups.driver_rollup, "driver")):
        assert rollup(trips).orderBy(key).collect() == rollup(cube).orderBy(key).collect()


def test_drivers_are_joined_only_if_needed(spark):
    def joins(tables, keys):
        return plan(tables.cube(41, *PERIOD, keys=keys).rows).count("Join")

    unique = star(spark, unique_drivers=True)
    assert joins(unique, ("day", "vehicle")) == 3
    assert joins(unique, ("day", "driver")) == 5
    assert joins(star(spark), ("day", "vehicle")) == 5
    without = unique.extract(41, *PERIOD, with_driver=False).collect()
    assert [r.nome for r in without] == [None] * 3
    assert len(star(spark).extract(41, *PERIOD, with_driver=False).collect()) == 3


def test_active_days_of_a_driver_without_times(spark):
    rows = [(None, "A", "ana", "3", "x"), ("2025-09-01 06:00:00", "A", "rui", "0", "x")]
    found = rollups.driver_active_days(fx.trips_of(spark, rows))
    assert fx.tuples(found) == [("Ana", 0)]
