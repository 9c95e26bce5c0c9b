"""SQL text, JDBC options, lookups, generated trips, staging and writing."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from tripmill import Trips, run_report, write_report
from tripmill.checks import bindings
from tripmill.functions.dates import time_or_null
from tripmill.operators.rollups import vehicle_rollup
from tripmill.operators.series import vehicle_series
from tripmill.plans import staging
from tripmill.plans.report import kpi_cards
from tripmill.sources import jdbc, lookup
from tripmill.sources.sqltext import load_dataframe
from tripmill.sources.star import within_period
from tripmill.sources.synthetic import DRIVERS, VEHICLES, synthetic_trips

ENV = {"DB_USER": "u", "DB_PASS": "p", "DB_HOST": "h", "DB_PORT": "3306", "DB_NAME": "d"}


def test_sql_parameters(spark):
    sql = "SELECT id FROM range(10) WHERE id BETWEEN :low AND :high ORDER BY id"
    assert [r.id for r in load_dataframe(spark, sql, {"low": 3, "high": 5}).collect()] == [3, 4, 5]
    assert load_dataframe(spark, "SELECT 1 AS one").first().one == 1


def test_datetime_parameters_ignore_the_session_zone(spark):
    spark.sql("SELECT timestamp_ntz'2025-09-01 00:00:00' AS t").createOrReplaceTempView("moments")
    sql = "SELECT count(*) AS n FROM moments WHERE t BETWEEN :start AND :end"
    params = {"start": datetime(2025, 9, 1), "end": datetime(2025, 9, 1)}
    for zone in ("America/Sao_Paulo", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert load_dataframe(spark, sql, params).first().n == 1


def test_connection_options():
    assert jdbc.connection_options(ENV) == {
        "url": "jdbc:mysql://h:3306/d",
        "user": "u",
        "password": "p",
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
    }
    with pytest.raises(KeyError):
        jdbc.connection_options({})


def test_split_options():
    assert jdbc.table_options("loads") == {"dbtable": "loads"}
    split = jdbc.table_options(
        "loads", partition_column="time", lower="2025-01-01", upper=datetime(2026, 1, 1), partitions=64
    )
    assert split == {
        "dbtable": "loads",
        "partitionColumn": "time",
        "lowerBound": "2025-01-01",
        "upperBound": "2026-01-01 00:00:00",
        "numPartitions": "64",
    }
    with pytest.raises(ValueError):
        jdbc.table_options("loads", partition_column="time")


def test_facts_are_always_split(spark):
    with pytest.raises(ValueError, match="two ranges"):
        jdbc.read_fact(spark, "loads", partition_column="time", lower=0, upper=9, partitions=1, env=ENV)
    with pytest.raises(TypeError):
        jdbc.read_fact(spark, "loads")


def test_instants_are_read_in_the_session_zone(spark):
    """The day of a TIMESTAMP moves with the zone; that of a zoneless time does not."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    def days():
        moments = spark.range(1).select(
            F.timestamp_seconds(F.lit(1756686600) + F.col("id")).alias("i"),
            F.lit("2025-09-01 00:30:00").cast("timestamp_ntz").alias("z"),
        )
        return tuple(
            moments.select(*[F.to_date(time_or_null(moments, c)).cast("string").alias(c) for c in ("i", "z")]).first()
        )

    assert days() == ("2025-09-01", "2025-09-01")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert days() == ("2025-08-31", "2025-09-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_each_bound_of_a_period_holds_alone(spark):
    rows = [("2025-09-01 00:00:00",), ("2025-09-02 00:00:00",), ("2025-09-03 00:00:00",), ("no time",), (None,)]
    loads = spark.createDataFrame(rows, "time string")

    def days(**bounds):
        return [r.time[8:10] for r in within_period(loads, **bounds).orderBy("time").collect()]

    assert days(start="2025-09-02 00:00:00") == ["02", "03"]
    assert days(end=datetime(2025, 9, 2)) == ["01", "02"]
    assert days(start="2025-09-02 00:00:00", end="2025-09-02 00:00:00") == ["02"]
    assert within_period(loads).count() == 5


def test_loads_without_a_driver_are_spread(spark):
    folder = "/root/testdata/sf0.01"
    star = bindings.anonymous_star(spark, folder)
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        sizes = [r["n"] for r in star.with_driver(star.loads).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
    assert max(sizes) < 2 * sum(sizes) / 8


def test_stages_of_a_run_are_removed(spark):
    with staging.staging_run(spark) as folder:
        frame = staging.staged(spark.range(3))
        assert frame.count() == 3
        assert Path(folder).exists()
    assert not Path(folder).exists()
    with pytest.raises(RuntimeError), staging.staging_run(spark) as folder:
        staging.staged(spark.range(3))
        raise RuntimeError("the report failed")
    assert Path(folder).exists()


def test_a_folder_must_be_named(spark, monkeypatch):
    monkeypatch.setattr(staging, "configured_folder", lambda spark: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(spark)


def test_site_name(spark):
    sites = spark.createDataFrame([(1, "Norte"), (2, None)], "id int, desc_obra string")
    names = [lookup.site_name(sites, i).first().site_name for i in (1, 2, 3)]
    assert names == ["Norte", "Obra 2", "Obra 3"]


def test_brand(spark):
    rows = spark.createDataFrame([("SÃO JOÃO",), ("São João",), (None,)], "site string")
    found = rows.select(lookup.brand(F.col("site"), ("SÃO JOÃO",)).alias("b")).collect()
    assert [r.b for r in found] == ["A", "B", "B"]


def test_synthetic_trips(spark):
    trips = synthetic_trips(spark).orderBy("time").collect()
    assert len(trips) == 40
    assert trips[0].time == datetime(2025, 10, 1, 6)
    assert trips[-1].time == datetime(2025, 10, 14, 6)
    assert {t.nome for t in trips} <= set(DRIVERS)
    assert {t.prefixo_veiculo for t in trips} <= set(VEHICLES)
    assert all(18 <= t.volume_descarregado <= 35 for t in trips)
    assert synthetic_trips(spark).orderBy("time").collect() == trips
    many = synthetic_trips(spark, 5000, seed=3)
    assert many.select("volume_descarregado").distinct().count() == 18
    assert vehicle_rollup(Trips(many)).count() == 3


def test_staged_rows_survive(spark):
    rows = fx.spoiled_frame(spark)
    assert sorted(map(repr, staging.staged(rows).collect())) == sorted(map(repr, rows.collect()))


def test_shared_folder_is_the_configured_one(spark):
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_write_report(spark, tmp_path, fmt):
    trips = fx.spoiled_trips(spark)
    sections = {"vehicle_series": vehicle_series(trips), "kpi_cards": kpi_cards(trips)}
    written = write_report(sections, str(tmp_path / "out"), fmt)
    reader = spark.read.format(fmt).schema(sections["vehicle_series"].schema)
    found = reader.load(f"{written}/vehicle_series")
    assert found.count() == 6
    assert found.agg(F.sum("total")).first()[0] == 104.75
    assert (tmp_path / "out" / "kpi_cards" / "_SUCCESS").exists()


def test_run_report(spark, tmp_path):
    from test_edges import star

    runs = Path(staging.shared_folder(spark).removeprefix("file:"))
    before = set(runs.glob("run-*"))
    written = run_report(star(spark), 41, "2025-09-01 00:00:00", "2025-09-30 23:59:59", str(tmp_path / "r"))
    header = spark.read.parquet(f"{written}/header").first()
    assert (header.company, header.period) == ("Norte", "De 01/09/2025 a 30/09/2025")
    cards = {r.position: r.value for r in spark.read.parquet(f"{written}/kpi_cards").collect()}
    assert cards[1] == "60,00"
    assert set(runs.glob("run-*")) == before
