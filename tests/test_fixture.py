"""The spoiled trips through every rollup, from each kind of source."""

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from tripmill import Cover, TripCube, TripSummary, build_report
from tripmill.functions.dates import clock_text
from tripmill.operators import kpis, rollups, series


def _raw(spark):
    return fx.spoiled_trips(spark)


def _shuffled(spark):
    trips = fx.spoiled_trips(spark)
    trips.rows = trips.rows.orderBy(F.xxhash64("time", "driver")).repartition(5)
    return trips


def _cube(spark):
    return TripCube(fx.spoiled_trips(spark).measures("day", "vehicle", "driver", "site"))


def _summary(spark):
    return TripSummary(fx.spoiled_trips(spark))


@pytest.fixture(scope="module", params=[_raw, _shuffled, _cube, _summary], ids=lambda f: f.__name__)
def source(request, spark):
    return request.param(spark)


def test_kpis(source):
    (row,) = kpis.kpi_summary(source).collect()
    assert row.asDict() == fx.KPIS


def test_single_kpis(source):
    assert fx.tuples(kpis.top_vehicle(source)) == [("TRK-200", "Trk-200")]
    assert fx.tuples(kpis.top_driver(source)) == [("maria-joao", "Maria-Joao")]
    assert fx.tuples(kpis.best_day(source)) == [(fx.day(1),)]
    assert fx.tuples(kpis.worst_positive_day(source)) == [(fx.day(4),)]
    assert fx.tuples(kpis.active_days(source)) == [(5,)]
    assert fx.tuples(kpis.first_site(source)) == [(fx.SITE,)]
    assert {r[0] for r in kpis.days_positive(source).collect()} == {fx.day(1), fx.day(2), fx.day(4)}


def test_daily(source):
    found = rollups.daily_rollup(source).orderBy("day")
    shown = found.select(
        "day",
        "n_trips",
        "total",
        "mean_load",
        "vehicles",
        clock_text(F.col("first_time")),
        clock_text(F.col("last_time")),
    )
    assert fx.tuples(shown) == fx.DAILY


def test_vehicles(source):
    found = rollups.largest_first(rollups.vehicle_rollup(source), "vehicle")
    assert fx.tuples(found.select("vehicle", "n_loads", "total", "mean_load")) == fx.VEHICLES
    assert fx.tuples(series.vehicle_series(source)) == fx.VEHICLE_SERIES


def test_drivers(source):
    found = rollups.largest_first(rollups.driver_rollup(source), "driver")
    columns = ("driver", "n_loads", "total", "mean_load", "active_days", "mean_per_day")
    assert fx.tuples(found.select(*columns)) == fx.DRIVERS
    bars = series.driver_bars(source).select("driver_raw", "total", "label")
    assert fx.tuples(bars) == fx.DRIVER_SERIES


def test_report_texts(spark):
    sites = spark.createDataFrame([(41, "Norte")], "id int, desc_obra string")
    cover = Cover(sites, 41, "2025-09-01 00:00:00", "2025-09-30 23:59:59")
    sections = build_report(fx.spoiled_trips(spark), cover)
    assert list(sections)[:8] == [
        "header",
        "kpi_cards",
        "daily_series",
        "daily_table",
        "vehicle_series",
        "vehicle_table",
        "driver_series",
        "driver_table",
    ]
    (header,) = sections["header"].collect()
    assert header.company == "Norte"
    assert header.brand == "A"
    assert header.period == "De 01/09/2025 a 30/09/2025"
    cards = {r.position: r.value for r in sections["kpi_cards"].collect()}
    assert cards == {
        1: "114,75",
        2: "12",
        3: "Trk-200",
        4: "Maria-Joao",
        5: "22,95",
        6: "01/09/2025\n04/09/2025",
    }
    days = sections["daily_table"].orderBy("page_no", "row_in_page").collect()
    assert tuple(days[1])[:7] == ("02/09/2025", "trk-050, TRK-300", "3", "35,50", "11,83", "05:59", "09:00")
    assert {r.section_title for r in days} == {"Produção Diária: de 01/09/2025 a 05/09/2025"}
    drivers = sections["driver_table"].orderBy("page_no", "row_in_page").collect()
    assert [(r.motorista, r.media_dia) for r in drivers] == [
        ("João da Silva", "55,12"),
        ("Maria-Joao", "25,06"),
        ("Não Definido", "5,75"),
        ("", ""),
        ("Ana", ""),
        ("d'Ávila", ""),
    ]
    status = {r.section: (r.n_rows, r.message) for r in sections["status"].collect()}
    assert status == {
        "daily_series": (5, None),
        "daily_table": (5, None),
        "vehicle_series": (6, None),
        "vehicle_table": (6, None),
        "driver_series": (9, None),
        "driver_table": (6, None),
    }
