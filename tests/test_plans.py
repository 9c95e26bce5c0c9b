"""What the physical plans may and may not contain."""

import re

import pytest

import __spark_entry__ as entry_point
from compare import plan
from tripmill.checks import bindings
from tripmill.checks.queries import all_queries
from tripmill.operators import kpis, measures, pages, rollups
from tripmill.plans import report
from tripmill.plans.staging import staged

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_single_task_window(spark, monkeypatch, name):
    """Holds for the result and for every frame that is staged on the way to it."""
    plans = []

    def recorded(df, **options):
        plans.append(plan(df))
        return staged(df, **options)

    for module in (measures, pages, report):
        monkeypatch.setattr(module, "staged", recorded)
    plans.append(plan(QUERIES[name](spark, FOLDER)))
    if name.startswith("report_driver_table"):
        assert len(plans) == 2
    text = "\n".join(plans)
    assert "Python" not in text
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    windows = re.findall(r"Window \[.*\], \[(.*?)\], \[", text)
    assert all(windows), "a window without partition keys"


def test_vehicles_meet_small_sides_without_a_shuffle_of_the_loads(spark):
    text = plan(QUERIES["vehicle_production"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastExchange") == 3


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["trip_extract"](spark, FOLDER), "formatted")
    assert "EqualTo(l_linenumber,3)" in text
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in text
    text = plan(QUERIES["src_param_sql"](spark, FOLDER), "formatted")
    assert "EqualTo(l_linenumber,3)" in text
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in text
    text = plan(QUERIES["extract_from"](spark, FOLDER), "formatted")
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in text
    text = plan(QUERIES["filter_period"](spark, FOLDER), "formatted")
    assert "LessThanOrEqual(ts,2024-01-12T18:30)" in text


def test_only_needed_columns_are_read(spark):
    text = plan(rollups.vehicle_rollup(bindings.clean_trips(spark, FOLDER)).select("vehicle", "total"))
    assert "ReadSchema: struct<event_type:string,value:double>" in text


def test_kpis_scan_the_trips_once(spark):
    text = plan(kpis.kpi_summary(bindings.clean_trips(spark, FOLDER)))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 2


def test_loads_are_aggregated_before_the_joins(spark):
    cube = bindings.star_tables(spark, FOLDER).cube(keys=("vehicle",))
    lines = plan(cube.measures("vehicle")).splitlines()
    first_aggregate = max(i for i, line in enumerate(lines) if "HashAggregate" in line)
    last_join = max(i for i, line in enumerate(lines) if "l_partkey" in line and "Join" in line)
    assert first_aggregate > last_join
    assert not any("orders.parquet" in line for line in lines)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
