"""Counts of repaired input, chunks of vehicle lists, and reads by predicate list."""

from datetime import date

import pytest
import fixtures as fx
from compare import plan
from tripmill import TripCube, TripSummary
from tripmill.operators import kpis, rollups
from tripmill.sources import jdbc

CHECKS = {
    "trips": 15,
    "times_unreadable": 2,
    "times_missing": 1,
    "volumes_unreadable": 3,
    "volumes_missing": 2,
    "vehicles_without_name": 3,
    "drivers_without_name": 4,
}


def spoiled(spark):
    more = [("no time", "A", "x", "1"), ("", "", " ", "1e999"), ("2025-09-01 00:00:00", "A", "x", None)]
    return fx.trips_of(spark, [(*r, fx.SITE) for r in [*fx.ROWS, *more]])


def test_repairs_are_counted_in_any_source(spark):
    trips = spoiled(spark)
    cube = TripCube(trips.measures("day", "vehicle", "driver", "site"))
    for source in (trips, cube, TripSummary(trips)):
        assert {r.check: r.n for r in kpis.input_checks(source).collect()} == CHECKS
    none = {r.check: r.n for r in kpis.input_checks(fx.trips_of(spark, [])).collect()}
    assert none == dict.fromkeys(CHECKS, 0)
    assert plan(kpis.input_checks(trips)).count("Scan") == 1


@pytest.mark.parametrize("size", [1, 2, 100])
def test_chunks_join_to_the_list(spark, size):
    names = [f"{'t' if i % 2 else 'T'}{i:03d}" for i in range(57)] + ["T001 ", ""]
    rows = [(f"2025-09-{1 + i % 3:02d} 00:00:00", n, "d", "1", "S") for i, n in enumerate(names) for _ in range(2)]
    trips = fx.trips_of(spark, rows)
    chunks = rollups.daily_vehicle_chunks(trips, size).orderBy("day", "chunk").collect()
    lists = {r.day: r.vehicles for r in rollups.daily_vehicle_lists(trips).collect()}
    joined = {}
    for r in chunks:
        assert r.n_vehicles == len(r.vehicles.split(", ")) <= size
        joined.setdefault(r.day, []).append(r.vehicles)
    assert {d: ", ".join(v) for d, v in joined.items()} == lists


def rows_by_predicate(spark, values, column, predicates):
    """Values that each predicate holds for, by Spark's own functions of the same names."""
    spark.createDataFrame([(v,) for v in values], f"{column} string").createOrReplaceTempView("loads_by_predicate")
    return [[r[0] for r in spark.sql(f"SELECT {column} FROM loads_by_predicate WHERE {p}").collect()] for p in predicates]


def test_month_predicates_hold_once(spark):
    rows = ["2024-11-30", "2024-12-01", "2024-12-31 23:59:59", "2025-01-01", "2025-02-28", "2025-03-01", "1999-01-01", None]
    predicates = jdbc.month_predicates("t", date(2024, 12, 5), date(2025, 2, 1))
    found = rows_by_predicate(spark, rows, "t", predicates)
    assert [len(f) for f in found] == [2, 1, 1, 3, 1]
    assert sorted(sum(found, []), key=str) == sorted(rows, key=str)
    with pytest.raises(ValueError):
        jdbc.month_predicates("t", date(2025, 2, 1), date(2024, 12, 1))


def test_hash_predicates_hold_once(spark):
    sizes = [len(f) for f in rows_by_predicate(spark, [*(str(i * i) for i in range(1000)), None], "id", jdbc.hash_predicates("id", 4))]
    assert sum(sizes) == 1001
    assert max(sizes) < 2 * min(sizes)
    for wrong in (lambda: jdbc.hash_predicates("id", 0), lambda: jdbc.read_by_predicates(None, "loads", ["1 = 1"], {})):
        with pytest.raises(ValueError):
            wrong()
