"""Periods over loads partitioned by date."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from compare import plan
from tripmill.checks.bindings import star_tables
from tripmill.sources.partitions import DayPartitions, write_by_date
from tripmill.sources.star import within_period

DAYS = 60
START, END = "2025-02-10 06:00:00", "2025-02-12 18:00:00"
LAYOUTS = {
    "day": DayPartitions(("day",)),
    "month": DayPartitions(("part",), "month"),
    "year": DayPartitions(("part",), "year"),
    "year month": DayPartitions(("y", "m")),
    "year month day": DayPartitions(("y", "m", "d")),
}


def loads(spark, kind="timestamp_ntz"):
    """Four loads a day at 00:00, 06:00, 12:00 and 18:00, and one without a time."""
    hours = spark.range(0, DAYS * 4, 1, 3)
    time = F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, id * 6)")
    rows = hours.select("id", time.cast(kind).alias("time"))
    return rows.unionByName(spark.range(1).select(F.lit(-1).cast("bigint").alias("id"), F.lit(None).cast(kind).alias("time")))


def expected(start=START, end=END):
    first = datetime(2025, 1, 1)
    times = {i: first + timedelta(hours=6 * i) for i in range(DAYS * 4)}
    low = datetime.fromisoformat(start) if start else datetime.min
    high = datetime.fromisoformat(end) if end else datetime.max
    return [i for i, t in times.items() if low <= t <= high]


def files_read(df):
    """Files that the scan opens; a frame of its own, as the number is set in the first run only."""
    run = df.select("*")
    run.collect()
    leaves = run._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_same_loads_from_fewer_files(spark, tmp_path, layout, kind):
    partitions = LAYOUTS[layout]
    folder = write_by_date(loads(spark, kind), str(tmp_path / "loads"), partitions)
    copy = spark.read.parquet(folder)
    assert copy.count() == DAYS * 4 + 1
    found = within_period(copy, START, END, "time", partitions)
    assert sorted(r.id for r in found.collect()) == expected()
    assert "PartitionFilters: []" not in plan(found)
    opened, every = files_read(found), files_read(copy)
    if partitions.finest == "day":
        # Three days, two of slack around instants, and the folder without a date.
        assert opened <= (5 if kind == "timestamp" else 3) * (every // DAYS + 1) + 1
    elif partitions.finest == "month":
        assert opened < every


@pytest.mark.parametrize("bounds", [(START, None), (None, END), (None, None)])
def test_each_bound_alone(spark, tmp_path, bounds):
    partitions = DayPartitions()
    copy = spark.read.parquet(write_by_date(loads(spark), str(tmp_path / "loads"), partitions))
    found = sorted(r.id for r in within_period(copy, *bounds, "time", partitions).collect())
    assert found == (expected(*bounds) if any(bounds) else [-1, *range(DAYS * 4)])


def test_instants_of_another_zone_are_not_lost(spark, tmp_path):
    """Folders are named by UTC dates; the session reads instants in a zone three hours behind."""
    rows = loads(spark, "timestamp")
    copy = spark.read.parquet(write_by_date(rows, str(tmp_path / "loads")))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        plain = within_period(copy, START, END)
        pruned = within_period(copy, START, END, "time", DayPartitions())
        assert sorted(r.id for r in pruned.collect()) == sorted(r.id for r in plain.collect())
        assert files_read(pruned) < files_read(plain) / 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_names_of_partitions(spark):
    def days(partitions, *rows):
        names = ", ".join(f"{c} string" for c in partitions.columns)
        frame = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], names)
        return [tuple(r) for r in frame.select(partitions.first_day(frame), partitions.last_day(frame)).collect()]

    feb = (date(2024, 2, 1), date(2024, 2, 29))
    year = (date(2024, 1, 1), date(2024, 12, 31))
    day = (date(2024, 2, 3),) * 2
    assert days(DayPartitions(("p",)), "2024-02-03", "20240203", "2024-2-3", "x", None) == [day] * 3 + [(None, None)] * 2
    assert days(DayPartitions(("p",), "month"), "2024-02", "202402", "2024-2", "2024-13") == [feb] * 3 + [(None, None)]
    assert days(DayPartitions(("p",), "year"), "2024") == [year]
    assert days(DayPartitions(("y", "m")), ("2024", "2"), ("2024", "02"), ("2024", None)) == [feb, feb, (None, None)]
    assert days(DayPartitions(("y", "m", "d")), ("2024", "2", "3")) == [day]
    for wrong in ({"columns": ()}, {"columns": "day"}, {"grain": "week"}):
        with pytest.raises(ValueError):
            DayPartitions(**wrong)


def test_unreadable_partitions_are_left_to_the_time(spark):
    rows = spark.createDataFrame([("?", "2025-02-11 00:00:00"), (None, "2025-02-11 00:00:00"), ("?", "2025-03-11 00:00:00")], "day string, time string")
    assert within_period(rows, START, END, "time", DayPartitions()).count() == 2


def test_a_crowded_date_is_several_files(spark, tmp_path):
    crowd = spark.range(0, 4000, 1, 4).select("id", F.lit("2025-01-01 10:00:00").cast("timestamp_ntz").alias("time"))
    # Spark puts such small ranges together unless told not to.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copy = spark.read.parquet(write_by_date(crowd, str(tmp_path / "loads")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(copy.inputFiles()) > 1
    assert copy.count() == 4000


def test_the_star_passes_its_partitions_on(spark, tmp_path):
    from dataclasses import replace

    star = star_tables(spark, "/root/testdata/sf0.001")
    months = DayPartitions(("ship_month",), "month")
    copy = spark.read.parquet(write_by_date(star.loads, str(tmp_path / "loads"), months, "l_shipdate"))
    by_month = replace(star, loads=copy, columns=replace(star.columns, partitions=months))
    text = plan(by_month.cube(3, "1996-01-01 00:00:00", "1996-03-31 23:59:59").rows)
    assert "PartitionFilters: [((last_day(" in text or "PartitionFilters: [(((last_day(" in text
    selected = by_month.selected_loads(3, "1996-01-01 00:00:00", "1996-03-31 23:59:59")
    assert selected.count() == star.selected_loads(3, "1996-01-01 00:00:00", "1996-03-31 23:59:59").count()
    assert files_read(selected) < len(copy.inputFiles()) / 10
