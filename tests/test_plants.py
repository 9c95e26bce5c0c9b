"""Reports of many plants from one pass."""

from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from compare import plan
from tripmill import run_report
from tripmill.checks.bindings import star_tables
from tripmill.checks.queries import PERIOD, SECTION_TEXTS, long_form, read_back
from tripmill.operators import kpis, measures, pages, rollups, series
from tripmill.plans import report
from tripmill.plans.publish import current, read_section
from tripmill.plans.staging import staged

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("plants") / "reports")
    report.run_plant_reports(star_tables(spark, FOLDER), *PERIOD, output)
    return output


@pytest.mark.parametrize("plant", [1, 7])
def test_each_plant_as_a_report_of_its_own(spark, published, tmp_path, plant):
    found = long_form(lambda s: read_section(spark, published, s).where(F.col("plant") == plant), SECTION_TEXTS)
    single = run_report(star_tables(spark, FOLDER), plant, *PERIOD, str(tmp_path / "one"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, read_back(spark, single).collect()))


def test_sections_are_laid_out_by_plant(spark, published):
    row = current(spark, published)
    assert set(row.sections) == {*SECTION_TEXTS, "headings", "input_checks"}
    cards = read_section(spark, published, "kpi_cards").where("plant = 2")
    assert "PartitionFilters: [isnotnull(plant), (plant = 2)]" in plan(cards)
    assert cards.count() == 6


def test_loads_are_scanned_once(spark, monkeypatch):
    plans = []

    def recorded(df, **options):
        plans.append(plan(df, "extended"))
        return staged(df, **options)

    for module in (measures, pages, report):
        monkeypatch.setattr(module, "staged", recorded)
    cube = star_tables(spark, FOLDER).cube(None, *PERIOD, by_plant=True)
    sections = report.build_report(cube, report.Cover(star_tables(spark, FOLDER).sites, None, *PERIOD, id_column="n_nationkey", name_column="n_name"))
    plans += [plan(s) for s in sections.values()]
    physical = [p.split("== Physical Plan ==")[-1] for p in plans]
    assert sum(p.count("lineitem.parquet") for p in physical) == 1


def test_some_plants_and_loads_without_one(spark, tmp_path):
    star = star_tables(spark, FOLDER)
    plant = F.when(F.col("l_linenumber") != 5, F.col("l_linenumber"))
    star = replace(star, loads=star.loads.withColumn("l_linenumber", plant))
    every, some = str(tmp_path / "all"), str(tmp_path / "some")
    report.run_plant_reports(star, *PERIOD, every)
    report.run_plant_reports(star, *PERIOD, some, plants=[2, 5])
    plants = {output: {r.plant for r in read_section(spark, output, "header").collect()} for output in (every, some)}
    assert plants == {every: {1, 2, 3, 4, 6, 7}, some: {2}}


def test_pages_count_within_the_scope(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("plant"), F.xxhash64("id").alias("key")
    )
    found = pages.with_pages(staged(rows), [F.col("key")], 38, 16, scope=("plant",))
    place = F.row_number().over(Window.partitionBy("plant").orderBy("key")) - 1
    wrong = found.withColumn("place", place).where("page_no <> floor(place / 38) + 1 OR row_in_page <> place % 38 + 1")
    assert found.count() == 3000 and wrong.count() == 0


def test_every_operator_carries_the_scope(spark):
    cube = star_tables(spark, FOLDER).cube(by_plant=True)
    operators = [
        kpis.kpi_summary,
        kpis.top_vehicle,
        kpis.top_driver,
        kpis.best_day,
        kpis.worst_positive_day,
        kpis.days_positive,
        kpis.active_days,
        kpis.observed_period,
        kpis.first_site,
        rollups.daily_rollup,
        rollups.daily_vehicles,
        rollups.vehicle_rollup,
        rollups.driver_rollup,
        rollups.driver_active_days,
        series.daily_points,
        series.vehicle_series,
        series.driver_bars,
        kpis.input_checks,
        rollups.daily_vehicle_chunks,
        report.section_status,
        report.section_captions,
    ]
    for operator in operators:
        found = operator(cube)
        assert found.columns[0] == "plant", operator
    assert kpis.kpi_summary(cube).count() == 7
