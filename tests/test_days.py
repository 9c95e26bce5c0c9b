"""Sets of days: one number per driver and month."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from compare import plan
from tripmill import Roles, TripCube, Trips, TripSummary
from tripmill.checks.bindings import dirty_trips, star_trips
from tripmill.operators import rollups

FOLDER = "/root/testdata/sf0.001"


def trips(spark, n=2000):
    """Loads over seven months with gaps, some of them empty, without a time or without a volume."""
    rows = []
    for i in range(n):
        time = datetime(2025, 1, 25) + timedelta(hours=(i * 37) % 4800)
        volume = None if i % 11 == 0 else 0.0 if i % 5 == 0 else -1.0 if i % 13 == 0 else float(i % 9)
        rows.append((None if i % 17 == 0 else time, "T", [None, "ana", "ANA", "bia"][i % 4], volume, "S"))
    return spark.createDataFrame(rows, "time timestamp_ntz, vehicle string, driver string, volume double, site string").repartition(5)


def brute(rows):
    days = {}
    for r in rows:
        label = {"ana": "Ana", "ANA": "Ana", "bia": "Bia", None: "Não Definido"}[r.driver]
        found = days.setdefault(label, set())
        if r.time and r.volume is not None and r.volume > 0:
            found.add(r.time.date())
    return {k: len(v) for k, v in days.items()}


def counted(source):
    return {r.driver: r.active_days for r in rollups.driver_rollup(source).select("driver", "active_days").collect()}


def sources(spark):
    whole = Trips(trips(spark), Roles.plain())
    return {
        "trips": whole,
        "cube": TripCube(whole.measures("day", "vehicle", "driver", "site")),
        "months": TripCube(rollups.driver_months(whole)),
        "summary": TripSummary(whole),
    }


@pytest.mark.parametrize("name", ["trips", "cube", "months", "summary"])
def test_days_with_loads(spark, name):
    assert counted(sources(spark)[name]) == brute(trips(spark).collect())


@pytest.mark.parametrize("cut", ["2025-03-01 00:00:00", "2025-03-15 09:00:00", "2024-01-01 00:00:00"])
def test_stored_periods_add_up(spark, cut):
    rows = trips(spark)
    early = F.coalesce(F.col("time") < F.lit(cut).cast("timestamp_ntz"), F.lit(True))
    halves = [rollups.driver_months(Trips(rows.filter(h), Roles.plain())) for h in (early, ~early)]
    merged = rollups.driver_rollup(TripCube(halves[0].unionByName(halves[1]))).orderBy("driver")
    whole = rollups.driver_rollup(Trips(rows, Roles.plain())).orderBy("driver")
    assert fx.tuples(merged.select(*sorted(merged.columns))) == fx.tuples(whole.select(*sorted(whole.columns)))


def test_days_need_their_month(spark):
    with pytest.raises(ValueError, match="month"):
        Trips(trips(spark), Roles.plain()).measures("driver", days=True)


def test_two_exchanges_to_the_rollup(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for binding in (dirty_trips, star_trips):
        text = plan(rollups.driver_rollup(binding(spark, FOLDER)))
        assert text.count("Exchange hashpartitioning(driver, month") == 1
        assert text.count("Exchange hashpartitioning(driver, 3)") == 1
        assert text.count("Exchange hashpartitioning(driver") == 2
    assert limit == spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
