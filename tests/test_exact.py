"""Exact sums: the same last bit from any order of the rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripmill import Roles, TripCube, Trips, TripSummary
from tripmill.checks import bindings
from tripmill.operators import exact, kpis, rollups, series

FOLDER = "/root/testdata/sf0.01"


def fractional(spark, parts):
    rows = bindings.fractional_rows(spark, FOLDER)
    return Trips(rows.repartition(parts, F.xxhash64("volume", F.lit(parts))), Roles.plain())


def results(source):
    daily = {r["day"]: r["volume"] for r in source.measures("day").select("day", "volume").collect()}
    ranks = [(r["driver"], r["volume"]) for r in rollups.largest_first(rollups.driver_rollup(source), "driver").collect()]
    return kpis.kpi_summary(source).first().asDict(), daily, ranks, [tuple(r) for r in series.vehicle_series(source).collect()]


@pytest.fixture(scope="module")
def first(spark):
    return results(fractional(spark, 1))


@pytest.mark.parametrize("parts", [3, 7, 16])
def test_any_partitioning(spark, first, parts):
    assert results(fractional(spark, parts)) == first


def test_any_steps(spark, first):
    trips = fractional(spark, 5)
    assert results(TripCube(trips.measures("day", "vehicle", "driver", "site"))) == first
    summary = TripSummary(trips)
    assert kpis.kpi_summary(summary).first().asDict() == first[0]
    assert [tuple(r) for r in series.vehicle_series(summary).collect()] == first[3]


def test_plain_sums_do_change(spark):
    """What the exact sums are for; if this fails, the test above shows nothing."""
    sums = {fractional(spark, n).rows.agg(F.sum("volume")).first()[0] for n in (1, 3, 7, 16)}
    assert len(sums) > 1


@pytest.mark.parametrize(
    "values",
    [
        [0.1] * 10,
        [-0.1] * 7 + [0.3],
        [1e6 + 0.3, -1e6, 0.7, -0.7],
        [0.0, -0.0],
        [8388607.999999999, 2.0**-60, -(2.0**-50)],
        [random.Random(i).uniform(-400, 400) for i in range(500)],
        [random.Random(i).lognormvariate(0, 6) % 8e6 for i in range(500)],
    ],
    ids=range(7),
)
def test_close_to_the_true_sum(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    (found,) = frame.agg(exact.total(exact.summed_limbs(exact.limbs(F.col("v"))))).first()
    true = sum((Fraction(v) for v in values), Fraction(0))
    # Below 2^-66 tons a value is cut off; the final addition rounds each of four parts once.
    assert abs(Fraction(found) - true) <= Fraction(math.ulp(float(true))) * 2 + len(values) * Fraction(1, 2**66)


def test_beyond_the_range_and_nothing(spark):
    frame = spark.createDataFrame([(1e300,), (-2.0**23,), (2.5,), (None,)], "v double")
    parts = exact.summed_limbs(exact.limbs(F.col("v")))
    assert frame.agg(exact.total(parts)).first()[0] == 1e300
    assert frame.where("v < 0 OR v < 3").agg(exact.total(parts)).first()[0] == -(2.0**23) + 2.5
    assert frame.where("v IS NULL").agg(exact.total(parts)).first()[0] == 0.0
    assert frame.limit(0).agg(exact.total(parts)).first()[0] == 0.0
