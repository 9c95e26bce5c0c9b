"""One query per operator, by name."""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.checks.bindings import (
    anonymous_star,
    clean_rows,
    clean_trips,
    crowded_star,
    dirty_rows,
    dirty_trips,
    fractional_cube,
    fractional_trips,
    star_tables,
    star_trips,
    star_trips_without_driver,
    table,
)
from tripmill.functions import dates, numbers, text
from tripmill.operators import kpis, rollups, series
from tripmill.operators.measures import MeasureSource, TripCube, Trips
from tripmill.operators.pages import paginate, ranking
from tripmill.plans import report
from tripmill.plans.publish import publish_report, read_section
from tripmill.plans.staging import fresh_folder, staged, staging_run
from tripmill.schema import Roles, ensure_columns, table_defaults
from tripmill.sources.lookup import site_name
from tripmill.sources.partitions import DayPartitions, write_by_date
from tripmill.sources.sqltext import load_dataframe
from tripmill.sources.star import at_site, within_period

Query = Callable[[SparkSession, str], DataFrame]
Binding = Callable[[SparkSession, str], MeasureSource]

SITE = 3
PERIOD = ("1996-01-01 00:00:00", "1996-12-31 23:59:59")
HALF_TIME = "2024-01-16 12:00:00"
OTHER_PERIOD = ("1995-01-01 00:00:00", "1995-01-31 23:59:59")
EVENT_PERIOD = ("2024-01-05 06:00:00", "2024-01-12 18:30:00")
DEFAULT_INSTANT = "2024-01-01 00:00:00"

TRIP_SQL = """
SELECT l.l_shipdate AS time, p.p_brand AS vehicle, f.c_name AS driver, l.l_quantity AS volume,
       n.n_name AS site
FROM star_lineitem AS l
JOIN star_part AS p ON l.l_partkey = p.p_partkey
JOIN star_supplier AS sr ON sr.s_suppkey = l.l_suppkey
JOIN star_nation AS n ON n.n_nationkey = sr.s_nationkey
LEFT JOIN star_orders AS mr ON mr.o_orderkey = l.l_orderkey
LEFT JOIN (SELECT * FROM star_customer WHERE c_acctbal >= :debt) AS f ON f.c_custkey = mr.o_custkey
WHERE l.l_linenumber = :site AND l.l_shipdate BETWEEN :start AND :end
"""

DAILY = ("day", "n_trips", "total", "mean_load", "vehicles", "first_time", "last_time")
VEHICLE = ("vehicle", "n_loads", "total", "mean_load")
DRIVER = ("driver", "n_loads", "total", "mean_load", "active_days", "mean_per_day")


def _over(binding: Binding, operator: Callable[[MeasureSource], DataFrame], *columns: str) -> Query:
    """An operator applied to one of the bindings, with some of its columns."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        result = operator(binding(spark, folder))
        return result.select(*columns) if columns else result

    return query


def _star_cube(*keys: str) -> Binding:
    return lambda spark, folder: star_tables(spark, folder).cube(keys=keys)


# Sources


def param_sql(spark: SparkSession, folder: str) -> DataFrame:
    for name in ("lineitem", "part", "supplier", "nation", "orders", "customer"):
        table(spark, folder, name).createOrReplaceTempView(f"star_{name}")
    start, end = PERIOD
    params = {"site": SITE, "start": start, "end": end, "debt": 0}
    return load_dataframe(spark, TRIP_SQL, params)


def trip_extract(spark: SparkSession, folder: str) -> DataFrame:
    return star_tables(spark, folder).extract(
        SITE, *PERIOD, names=Roles.plain(), tie_break=("l_orderkey", "l_linenumber")
    )


def extract_with(**bounds: str) -> Query:
    return lambda spark, folder: star_tables(spark, folder).extract(
        names=Roles.plain(), ordered=False, **bounds
    )


def site_name_lookup(spark: SparkSession, folder: str) -> DataFrame:
    sites = table(spark, folder, "supplier")
    known, unknown = (
        site_name(sites, i, "s_suppkey", "s_name").withColumn("site_id", F.lit(i))
        for i in (SITE, -1)
    )
    return known.unionByName(unknown)


# Columns of each section that are read back: page, row, and what is joined to its text.
SECTION_TEXTS = {
    "header": ("title", "company", "period", "brand", "generated_by", "console_line"),
    "kpi_cards": ("position", "title", "value"),
    "daily_series": ("day_label", "label", "total"),
    "daily_table": (
        "data",
        "caminhoes",
        "n_viagens",
        "total",
        "t_viagem",
        "primeira",
        "ultima",
        "section_title",
    ),
    "vehicle_series": ("vehicle", "total"),
    "vehicle_table": ("caminhao", "n_viagens", "total", "peso_medio", "section_title"),
    "driver_series": ("driver_raw", "label", "label_wrapped", "total"),
    "driver_table": ("motorista", "n_viagens", "total", "peso_medio", "media_dia", "section_title"),
    "captions": ("section", "caption"),
    "status": ("section", "n_rows", "message"),
}


def read_back(spark: SparkSession, written: str) -> DataFrame:
    """Every row of a written report as section, page, row in the page and text."""
    return long_form(lambda section: spark.read.parquet(f"{written}/{section}"), SECTION_TEXTS)


def long_form(
    read: Callable[[str], DataFrame], texts_of: dict[str, tuple[str, ...]], scope: tuple[str, ...] = ()
) -> DataFrame:
    parts = []
    for section, columns in texts_of.items():
        rows = read(section)
        numeric = {n for n, kind in rows.dtypes if kind == "double"}
        texts = [numbers.number_text(F.col(c)) if c in numeric else F.col(c).cast("string") for c in columns]
        paged_rows = "page_no" in rows.columns
        parts.append(
            rows.select(
                *scope,
                F.lit(section).alias("section"),
                (F.col("page_no") if paged_rows else F.lit(0)).cast("bigint").alias("page"),
                (F.col("row_in_page") if paged_rows else F.lit(0)).cast("bigint").alias("row"),
                F.concat_ws("|", *[F.coalesce(t, F.lit("")) for t in texts]).alias("texts"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the joined trips of one site and period, written and read."""
    selected = star_tables(spark, folder).extract(
        SITE, *PERIOD, names=Roles.plain(), ordered=False
    )
    written = fresh_folder(spark, "report")
    with staging_run(spark):
        sections = report.build_report(Trips(selected, Roles.plain()), _cover(spark, folder))
        report.write_report(sections, written)
    return read_back(spark, written)


def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """The same report as users run it, from aggregated loads."""
    written = fresh_folder(spark, "report")
    return read_back(spark, report.run_report(star_tables(spark, folder), SITE, *PERIOD, written))


def published_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report read through its manifest, where it replaced one of another period."""
    output, star = fresh_folder(spark, "published"), star_tables(spark, folder)
    other = star.cube(SITE, *OTHER_PERIOD, keys=("day", "vehicle", "driver"))
    publish_report({"kpi_cards": report.kpi_cards(other)}, output)
    report.run_report(star, SITE, *PERIOD, output)
    texts = SECTION_TEXTS | {"headings": ("section", "position", "column", "heading")}
    return long_form(lambda section: read_section(spark, output, section), texts)


def plant_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The reports of all plants from one pass, told by plant."""
    output = fresh_folder(spark, "plants")
    report.run_plant_reports(star_tables(spark, folder), *PERIOD, output)
    return long_form(lambda section: read_section(spark, output, section), SECTION_TEXTS, ("plant",))


# Filters and cleaning


def filter_site(spark: SparkSession, folder: str) -> DataFrame:
    loads = at_site(table(spark, folder, "lineitem"), SITE, "l_linenumber")
    return loads.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")


def filter_period(spark: SparkSession, folder: str) -> DataFrame:
    trips = within_period(table(spark, folder, "events"), *EVENT_PERIOD, time="ts")
    return trips.select("event_id", "ts", "event_type")


def by_date(rows: DataFrame, partitions: DayPartitions, time: str) -> DataFrame:
    """A copy of ``rows`` in folders by date."""
    spark = rows.sparkSession
    return spark.read.parquet(write_by_date(rows, fresh_folder(spark, "by-date"), partitions, time))


def filter_partitions(partitions: DayPartitions, kind: str) -> Query:
    """The period of the events, from a copy partitioned by date whose times are of another type."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        events = table(spark, folder, "events")
        copy = by_date(events.withColumn("moment", F.col("ts").cast(kind)), partitions, "moment")
        trips = within_period(copy, *EVENT_PERIOD, time="moment", partitions=partitions)
        return trips.select("event_id", "ts", "event_type")

    return query


def extract_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The extract of a site and period from loads partitioned by month."""
    star = star_tables(spark, folder)
    months = DayPartitions(("ship_month",), "month")
    star = replace(
        star, loads=by_date(star.loads, months, "l_shipdate"), columns=replace(star.columns, partitions=months)
    )
    return star.extract(SITE, *PERIOD, names=Roles.plain(), ordered=False)


def parse_period(spark: SparkSession, folder: str) -> DataFrame:
    ts, kind = F.col("ts"), F.col("event_type")
    day = F.concat_ws("-", F.year(ts), F.month(ts), F.day(ts))
    clock = F.concat_ws(":", F.hour(ts), F.minute(ts), F.second(ts))
    written = F.when(kind == "error", "").when(kind != "click", F.concat_ws(" ", day, clock))
    parsed = dates.parse_instant(written, dates.instant(DEFAULT_INSTANT))
    return table(spark, folder, "events").select("event_id", parsed.alias("instant"))


def default_period(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        dates.month_start(F.col("ts")).alias("period_start"),
        dates.month_end(F.col("ts")).alias("period_end"),
    )


def add_columns(spark: SparkSession, folder: str) -> DataFrame:
    partial = clean_rows(spark, folder).select("time", "driver")
    return ensure_columns(partial, table_defaults(Roles.plain()))


def coerce_time(spark: SparkSession, folder: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts").cast("string")
    written = (
        F.when(kind == "error", "abc")
        .when(kind == "click", F.substring(ts, 1, 10))
        .when(kind == "signup", F.concat(ts, F.lit(" x")))
        .otherwise(ts)
    )
    rows = table(spark, folder, "events").select("event_id", written.alias("written"))
    return rows.select("event_id", dates.time_or_null(rows, "written").alias("time"))


def coerce_volume(coerce: Callable[[DataFrame, str], Column]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = dirty_rows(spark, folder)
        return rows.select("event_id", coerce(rows, "volume").alias("volume"))

    return query


# Joins


def join_vehicle(spark: SparkSession, folder: str) -> DataFrame:
    star = star_tables(spark, folder)
    return star.with_vehicle(star.loads).select("l_orderkey", "l_linenumber", "vehicle")


def join_reader_site(spark: SparkSession, folder: str) -> DataFrame:
    star = star_tables(spark, folder)
    return star.with_site(star.loads).select("l_orderkey", "l_linenumber", "site")


def key_check(spark: SparkSession, folder: str) -> DataFrame:
    return star_tables(spark, folder).key_check()


def match_check(spark: SparkSession, folder: str) -> DataFrame:
    """Loads without a driver id, and tags and readers of which every fifth is unknown."""
    star = anonymous_star(spark, folder)
    return replace(
        star,
        vehicles=star.vehicles.filter(F.col("p_partkey") % 5 != 0),
        readers=star.readers.filter(F.col("s_suppkey") % 5 != 0),
    ).match_check()


def join_driver_nulls(spark: SparkSession, folder: str) -> DataFrame:
    star = anonymous_star(spark, folder)
    return star.with_driver(star.loads).select("l_orderkey", "l_linenumber", "entry", "driver")


def join_driver_left(spark: SparkSession, folder: str) -> DataFrame:
    star = star_tables(spark, folder)
    return star.with_driver(star.loads).select("l_orderkey", "l_linenumber", "driver")


def join_heavy_keys(spark: SparkSession, folder: str) -> DataFrame:
    """All three joins where one tag, one reader and one driver have a third of the loads each."""
    star = crowded_star(spark, folder).balanced()
    rows = star.with_driver(star.with_site(star.with_vehicle(star.loads)))
    return rows.select("load_order", "l_linenumber", "vehicle", "site", "driver")


# Scalars


def on_documents(function: Callable[[Column], Column], name: str) -> Query:
    return lambda spark, folder: table(spark, folder, "documents").select(
        "doc_id", function(F.col("text")).alias(name)
    )


def _net_price() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def round2(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.round2(_net_price()).alias("rounded")
    )


def format_ptbr(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.number_text(_net_price()).alias("price_text"),
        numbers.point_label(_net_price()).alias("price_label"),
    )


def format_dates(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        dates.date_text(ts).alias("date_text"),
        dates.clock_text(ts).alias("clock_text"),
        dates.iso_date_text(ts).alias("iso_text"),
    )


# Report sections


def _cover(spark: SparkSession, folder: str) -> report.Cover:
    return report.Cover(
        table(spark, folder, "nation"),
        SITE,
        *PERIOD,
        id_column="n_nationkey",
        name_column="n_name",
    )


def report_header(spark: SparkSession, folder: str) -> DataFrame:
    trips = star_tables(spark, folder).cube(SITE, *PERIOD, keys=("site",))
    return report.report_header(trips, _cover(spark, folder), stamped=False)


def ranked_by_total(
    binding: Binding, rollup: Callable[[MeasureSource], DataFrame], key: str
) -> Query:
    return lambda spark, folder: ranking(rollup(binding(spark, folder)), key).select(
        key, "total", F.col("rank").cast("bigint").alias("rank")
    )


def exact_ranking(binding: Binding) -> Query:
    """Drivers by unrounded total, to the last bit."""
    return lambda spark, folder: ranking(rollups.driver_rollup(binding(spark, folder)), "driver").select(
        "driver", "volume", "mean_load", F.col("rank").cast("bigint").alias("rank")
    )


def merged_halves(binding: Binding) -> Query:
    """The driver rollup from stored totals of two periods that meet in the middle of a month."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        trips = binding(spark, folder)
        late = F.coalesce(F.col("time") >= dates.instant(HALF_TIME), F.lit(False))
        halves = []
        for half in (late, ~late):
            trips_of_half = copy(trips)
            trips_of_half.rows = trips.rows.filter(half)
            halves.append(staged(rollups.driver_months(trips_of_half)))
        return rollups.driver_rollup(TripCube(halves[0].unionByName(halves[1]))).select(*DRIVER)

    return query


def paged(
    binding: Binding, rollup: Callable[[MeasureSource], DataFrame], key: str, size: int, by_total: bool
) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        order = [-F.col("volume"), F.col(key)] if by_total else [F.col(key)]
        pages = paginate(rollup(binding(spark, folder)), order, size)
        return pages.select(key, "total", "page_no", "row_in_page")

    return query


def all_queries() -> dict[str, Query]:
    """Every registered query. Names ending in ``_dirty`` repeat an operator on spoiled input."""
    dirty, clean, star, loads = dirty_trips, clean_trips, star_trips, star_trips_without_driver
    return {
        "src_param_sql": param_sql,
        "trip_extract": trip_extract,
        "extract_from": extract_with(start=PERIOD[0]),
        "extract_until": extract_with(end=PERIOD[1]),
        "key_check": key_check,
        "site_name_lookup": site_name_lookup,
        "sink_roundtrip": sink_roundtrip,
        "run_report": run_report,
        "published_report": published_report,
        "plant_reports": plant_reports,
        "filter_site": filter_site,
        "filter_period": filter_period,
        "filter_period_by_day": filter_partitions(DayPartitions(("day",)), "timestamp_ntz"),
        "filter_period_by_instant": filter_partitions(DayPartitions(("day",)), "timestamp"),
        "filter_period_by_text": filter_partitions(DayPartitions(("year", "month")), "string"),
        "extract_by_month": extract_partitions,
        "parse_period": parse_period,
        "default_period": default_period,
        "ensure_columns": add_columns,
        "coerce_volume_zero": coerce_volume(numbers.number_or_zero),
        "coerce_volume_null": coerce_volume(numbers.number_or_null),
        "coerce_time": coerce_time,
        "fill_text": lambda spark, folder: dirty_rows(spark, folder).select(
            "event_id",
            text.fill_text(F.col("vehicle")).alias("vehicle"),
            text.fill_text(F.col("driver")).alias("driver"),
        ),
        "driver_label_table": lambda spark, folder: dirty_rows(spark, folder).select(
            "event_id", text.driver_label_table(F.col("driver")).alias("label")
        ),
        "driver_label_series": lambda spark, folder: dirty_rows(spark, folder).select(
            "event_id", text.driver_label_series(F.col("driver")).alias("label")
        ),
        "join_vehicle": join_vehicle,
        "join_reader_site": join_reader_site,
        "join_driver_left": join_driver_left,
        "join_driver_nulls": join_driver_nulls,
        "join_heavy_keys": join_heavy_keys,
        "active_days": _over(clean, kpis.active_days),
        "active_days_dirty": _over(dirty, kpis.active_days),
        "daily_production": _over(clean, rollups.daily_rollup, *DAILY),
        "daily_production_dirty": _over(dirty, rollups.daily_rollup, *DAILY),
        "daily_production_cube": _over(_star_cube("day", "vehicle"), rollups.daily_rollup, *DAILY),
        "daily_vehicle_rows": _over(dirty, rollups.daily_vehicles),
        "daily_vehicle_chunks": _over(dirty, lambda source: rollups.daily_vehicle_chunks(source, 3)),
        "daily_vehicle_list": _over(dirty, rollups.daily_vehicle_lists),
        "vehicle_production": _over(loads, rollups.vehicle_rollup, *VEHICLE),
        "vehicle_production_cube": _over(
            _star_cube("vehicle"), rollups.vehicle_rollup, *VEHICLE
        ),
        "vehicle_ranking": ranked_by_total(loads, rollups.vehicle_rollup, "vehicle"),
        "vehicle_production_dirty": _over(dirty, rollups.vehicle_rollup, *VEHICLE),
        "driver_production": _over(star, rollups.driver_rollup, *DRIVER),
        "driver_production_cube": _over(
            _star_cube("day", "driver"), rollups.driver_rollup, *DRIVER
        ),
        "driver_ranking": ranked_by_total(star, rollups.driver_rollup, "driver"),
        "driver_production_dirty": _over(dirty, rollups.driver_rollup, *DRIVER),
        "driver_half_periods": merged_halves(dirty),
        "driver_active_days": _over(dirty, rollups.driver_active_days),
        "daily_series": _over(dirty, series.daily_series),
        "vehicle_series": _over(dirty, series.vehicle_series),
        "driver_series": _over(dirty, series.driver_series),
        "exact_kpis": _over(fractional_trips, kpis.kpi_summary),
        "exact_kpis_cube": _over(fractional_cube, kpis.kpi_summary),
        "exact_daily_totals": _over(fractional_trips, series.daily_series),
        "exact_vehicle_totals": _over(fractional_cube, series.vehicle_series),
        "exact_driver_ranking": exact_ranking(fractional_trips),
        "input_checks": _over(dirty, kpis.input_checks),
        "match_check": match_check,
        "observed_period": _over(dirty, kpis.observed_period),
        "days_positive": _over(dirty, kpis.days_positive),
        "top_vehicle": _over(dirty, kpis.top_vehicle),
        "top_driver": _over(star, kpis.top_driver),
        "top_driver_dirty": _over(dirty, kpis.top_driver),
        "best_day": _over(loads, kpis.best_day),
        "worst_positive_day": _over(dirty, kpis.worst_positive_day),
        "first_site": _over(loads, kpis.first_site),
        "first_site_cube": _over(_star_cube("site"), kpis.first_site),
        "kpi_summary": _over(star, kpis.kpi_summary),
        "kpi_summary_dirty": _over(dirty, kpis.kpi_summary),
        "paginate_daily": paged(
            loads, rollups.daily_rollup, "day", report.DAILY_PAGE, False
        ),
        "paginate_vehicle": paged(
            loads, rollups.vehicle_rollup, "vehicle", report.VEHICLE_PAGE, True
        ),
        "paginate_driver": paged(
            star, rollups.driver_rollup, "driver", report.DRIVER_PAGE, True
        ),
        "titlecase_pt": on_documents(text.titlecase, "cased"),
        "titlecase_card": on_documents(text.titlecase_card, "cased"),
        "wrap_label": on_documents(text.wrap_label, "wrapped"),
        "round2": round2,
        "format_ptbr": format_ptbr,
        "format_dates": format_dates,
        "section_caption": _over(dirty, report.section_captions),
        "report_header": report_header,
        "kpi_cards": _over(dirty, report.kpi_cards),
        "report_daily_series": _over(dirty, series.daily_points),
        "report_daily_table": _over(dirty, report.daily_table),
        "report_vehicle_series": _over(loads, series.vehicle_series),
        "report_vehicle_table": _over(dirty, report.vehicle_table),
        "report_driver_series": _over(star, series.driver_bars),
        "report_driver_table": _over(star, report.driver_table),
        "report_driver_table_dirty": _over(dirty, report.driver_table),
        "section_status": _over(dirty, report.section_status),
    }
