"""The report: one dataset per section, all from one staged summary.

Layout and drawing are not part of this library; each section is the data behind it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.dates import (
    clock_text,
    date_text,
    default_period,
    generation_stamp,
    instant,
    instant_text,
    parse_instant,
    span_text,
)
from tripmill.functions.numbers import number_text, number_text_if_positive
from tripmill.functions.text import dash_if_blank, driver_label_table, fill_text
from tripmill.operators.kpis import first_site, input_checks, kpi_summary, observed_period
from tripmill.operators.measures import FACETS, MeasureSource, TripSummary, grain_is
from tripmill.operators.pages import with_pages
from tripmill.operators.rollups import daily_rollup, driver_rollup, vehicle_rollup
from tripmill.operators.series import daily_points, driver_bars, vehicle_series
from tripmill.plans.publish import publish_report
from tripmill.plans.staging import staged, staging_run
from tripmill.plans.writing import DEFAULT_OUTPUT, write_report
from tripmill.sources.lookup import brand, site_name, site_names
from tripmill.sources.star import StarTables

# Report texts, page sizes, and the site that carries the first brand.
TITLE = "Relatório de Produção Mensal"
CARD_TITLES = (
    "Produção total do período (t)",
    "Número total de viagens",
    "Caminhão mais produtivo",
    "Motorista mais produtivo",
    "Produção média por dia (t)",
    "Maior / Menor dia (não zero)",
)
SECTION_TITLES = {
    "daily_series": "Produção diária",
    "daily_table": "Produção Diária",
    "vehicle_series": "Produção por Caminhão",
    "vehicle_table": "Produção por caminhão",
    "driver_series": "Produção por Motorista",
    "driver_table": "Produção por motorista",
}
PAGE_TITLES = {
    "kpi_cards": "Geral",
    "daily_series": "Produção diária",
    "vehicle_series": "Caminhões",
    "driver_series": "Motoristas",
}
COLUMN_TITLES = {
    "daily_table": {
        "data": "Data",
        "caminhoes": "Caminhões",
        "n_viagens": "Nº Viagens",
        "total": "Total (t)",
        "t_viagem": "t/Viagen",
        "primeira": "Primeira viagem",
        "ultima": "Última viagem",
    },
    "vehicle_table": {
        "caminhao": "Caminhão",
        "n_viagens": "N° de Viagens",
        "total": "Total (t)",
        "peso_medio": "Peso Médio (t/viagem)",
    },
    "driver_table": {
        "motorista": "Motorista",
        "n_viagens": "N° de Viagens",
        "total": "Total (t)",
        "peso_medio": "Peso Médio (t/viagem)",
        "media_dia": "Média (t/dia)",
    },
}
NO_ROWS = "Sem registros no período."
NO_POINTS = "Sem dados no período"
DAILY_PAGE = 48
VEHICLE_PAGE = 38
DRIVER_PAGE = 38
PRIMARY_SITES = ("SÃO JOÃO",)


def kpi_cards(source: MeasureSource) -> DataFrame:
    """The six cards as rows of position, title and text."""
    k = kpi_summary(source)
    best, worst = (F.coalesce(date_text(F.col(c)), F.lit("-")) for c in ("best_day", "worst_day"))
    texts = [
        number_text(F.col("total")),
        F.col("n_trips").cast("string"),
        dash_if_blank(F.col("top_vehicle")),
        dash_if_blank(F.col("top_driver")),
        number_text(F.col("mean_per_day")),
        F.concat(best, F.lit("\n"), worst),
    ]
    cards = [
        F.struct(F.lit(i).alias("position"), F.lit(title).alias("title"), text.alias("value"))
        for i, (title, text) in enumerate(zip(CARD_TITLES, texts, strict=True), start=1)
    ]
    return k.select(*source.scope, F.inline(F.array(*cards)))


def section_captions(source: MeasureSource) -> DataFrame:
    """Title and observed period of each chart and table; blank if no trip has a time."""
    captions = [
        F.struct(
            F.lit(section).alias("section"),
            span_text(F.col("first_time"), F.col("last_time"), f"{title}: de").alias("caption"),
        )
        for section, title in SECTION_TITLES.items()
    ]
    return observed_period(source).select(*source.scope, F.inline(F.array(*captions)))


def headings(spark: SparkSession) -> DataFrame:
    """Headings as data: of the pages (position 0, no column), and of the columns of each display table."""
    pages = [(section, 0, None, title) for section, title in PAGE_TITLES.items()]
    columns = [
        (section, i, column, title)
        for section, titles in COLUMN_TITLES.items()
        for i, (column, title) in enumerate(titles.items(), start=1)
    ]
    return spark.createDataFrame(pages + columns, "section string, position int, column string, heading string")


def section_status(source: MeasureSource) -> DataFrame:
    """Rows of each section, and the notice shown in place of a section without data.

    Charts of vehicles and drivers show the notice only if there are no trips at all. Vehicles and
    drivers that end up under one name count once, hence the second grouping by shown name.
    """
    on_day = grain_is("day") & F.col("day").isNotNull()
    vehicle, driver = F.col("vehicle"), F.col("driver")
    shown = F.array(
        F.when(on_day, F.struct(F.lit("day").alias("kind"), F.col("day").cast("string").alias("key"))),
        F.when(grain_is("vehicle"), F.struct(F.lit("vehicle").alias("kind"), fill_text(vehicle).alias("key"))),
        F.when(
            grain_is("vehicle") & vehicle.isNotNull(),
            F.struct(F.lit("named_vehicle").alias("kind"), vehicle.alias("key")),
        ),
        F.when(grain_is("driver"), F.struct(F.lit("raw_driver").alias("kind"), fill_text(driver).alias("key"))),
        F.when(grain_is("driver"), F.struct(F.lit("driver").alias("kind"), driver_label_table(driver).alias("key"))),
    )
    scope = source.scope
    shown_keys = source.grains(*FACETS).select(*scope, F.explode(F.array_compact(shown)).alias("shown"))
    distinct = shown_keys.select(*scope, "shown.kind", "shown.key").distinct()
    rows = {
        "daily_series": "day",
        "daily_table": "day",
        "vehicle_series": "named_vehicle",
        "vehicle_table": "vehicle",
        "driver_series": "raw_driver",
        "driver_table": "driver",
    }
    counted = distinct.groupBy(*scope).agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in sorted(set(rows.values()))]
    )
    emptied_by = rows | {"vehicle_series": "vehicle"}
    statuses = [
        F.struct(
            F.lit(section).alias("section"),
            F.col(kind).alias("n_rows"),
            F.when(
                F.col(emptied_by[section]) == 0,
                F.lit(NO_ROWS if section.endswith("_table") else NO_POINTS),
            ).alias("message"),
        )
        for section, kind in rows.items()
    ]
    return counted.select(*scope, F.inline(F.array(*statuses)))


def _paged(rollup: DataFrame, source: MeasureSource, order: list[Column], size: int, section: str) -> DataFrame:
    """Pages of a rollup with their headings; pages after the first are marked as continued."""
    span = span_text(F.min("first_time"), F.max("last_time"), ": de")
    pages = with_pages(rollup, order, size, scope=source.scope)
    if source.scope:
        spans = rollup.groupBy(*source.scope).agg(span.alias("_span"))
        pages, shown = pages.join(spans, list(source.scope)), F.col("_span")
    else:
        shown = rollup.agg(span).scalar()
    title = SECTION_TITLES[section]
    lead = F.when(F.col("page_no") == 1, title).otherwise(f"{title} (continuação)")
    return pages.withColumn("section_title", F.concat(lead, shown))


def _once(rollup: DataFrame, source: MeasureSource) -> DataFrame:
    """A rollup that is read several times: staged, unless its source is small and staged already."""
    return rollup if getattr(source, "is_staged", False) else staged(rollup)


def daily_table(source: MeasureSource, page_size: int = DAILY_PAGE) -> DataFrame:
    """Display rows per day, in date order."""
    rollup = _once(daily_rollup(source), source)
    pages = _paged(rollup, source, [F.col("day")], page_size, "daily_table")
    return pages.select(
        *source.scope,
        date_text(F.col("day")).alias("data"),
        dash_if_blank(F.col("vehicles")).alias("caminhoes"),
        F.col("n_trips").cast("string").alias("n_viagens"),
        number_text(F.col("total")).alias("total"),
        number_text(F.col("mean_load")).alias("t_viagem"),
        clock_text(F.col("first_time")).alias("primeira"),
        clock_text(F.col("last_time")).alias("ultima"),
        "page_no",
        "row_in_page",
        "section_title",
    )


def vehicle_table(source: MeasureSource, page_size: int = VEHICLE_PAGE) -> DataFrame:
    """Display rows per vehicle, largest total first; names are shown as they are stored."""
    rollup = _once(vehicle_rollup(source), source)
    pages = _paged(rollup, source, [-F.col("volume"), F.col("vehicle")], page_size, "vehicle_table")
    return pages.select(
        *source.scope,
        F.col("vehicle").alias("caminhao"),
        F.col("n_loads").cast("string").alias("n_viagens"),
        number_text(F.col("total")).alias("total"),
        number_text(F.col("mean_load")).alias("peso_medio"),
        "page_no",
        "row_in_page",
        "section_title",
    )


def driver_table(source: MeasureSource, page_size: int = DRIVER_PAGE) -> DataFrame:
    """Display rows per driver label, largest total first."""
    rollup = _once(driver_rollup(source), source)
    pages = _paged(rollup, source, [-F.col("volume"), F.col("driver")], page_size, "driver_table")
    return pages.select(
        *source.scope,
        F.col("driver").alias("motorista"),
        F.col("n_loads").cast("string").alias("n_viagens"),
        number_text(F.col("total")).alias("total"),
        number_text(F.col("mean_load")).alias("peso_medio"),
        number_text_if_positive(F.col("mean_per_day")).alias("media_dia"),
        "page_no",
        "row_in_page",
        "section_title",
    )


@dataclass(frozen=True)
class Cover:
    """What the cover states besides the trips themselves."""

    sites: DataFrame
    site: int | None
    start: str | datetime | Column | None = None
    end: str | datetime | Column | None = None
    id_column: str = "id"
    name_column: str = "desc_obra"
    title: str = TITLE
    generated_by: str = "tripmill"
    primary_sites: tuple[str, ...] = field(default=PRIMARY_SITES)


def _console_line(company: Column, start: Column, end: Column) -> Column:
    return F.concat(
        F.lit("Relatório: "), company, F.lit(" | Período: "), instant_text(start), F.lit(" a "), instant_text(end)
    )


def report_header(source: MeasureSource, cover: Cover, *, stamped: bool = True) -> DataFrame:
    """The cover in one row: title, company, period, brand, origin, console line and stamp.

    The period is the one asked for, not the one observed; the brand follows the site of the
    earliest trip.
    """
    company = site_name(cover.sites, cover.site, cover.id_column, cover.name_column).scalar()
    none = F.lit(None).cast("timestamp_ntz")
    start, end = (none if p is None else instant(p) for p in (cover.start, cover.end))
    header = first_site(source).select(
        F.lit(cover.title).alias("title"),
        company.alias("company"),
        span_text(start, end).alias("period"),
        brand(F.col("site"), cover.primary_sites).alias("brand"),
        F.lit(cover.generated_by).alias("generated_by"),
    )
    header = header.withColumn("console_line", _console_line(F.col("company"), start, end))
    return header.withColumn("generated_at", generation_stamp()) if stamped else header


def plant_headers(source: MeasureSource, cover: Cover) -> DataFrame:
    """The covers of all plants of a source whose scope is the plant; see :func:`report_header`."""
    (plant,) = source.scope
    names = site_names(cover.sites, cover.id_column, cover.name_column)
    first = first_site(source)
    named = first.join(names, F.col(plant) == F.col("id"), "left").withColumn(
        "company", F.coalesce("name", F.concat(F.lit("Obra "), F.col(plant).cast("string")))
    )
    none = F.lit(None).cast("timestamp_ntz")
    start, end = (none if p is None else instant(p) for p in (cover.start, cover.end))
    return named.select(
        plant,
        F.lit(cover.title).alias("title"),
        "company",
        span_text(start, end).alias("period"),
        brand(F.col("site"), cover.primary_sites).alias("brand"),
        F.lit(cover.generated_by).alias("generated_by"),
        _console_line(F.col("company"), start, end).alias("console_line"),
        generation_stamp().alias("generated_at"),
    )


def _sections(summary: TripSummary) -> dict[str, DataFrame]:
    return {
        "kpi_cards": kpi_cards(summary),
        "daily_series": daily_points(summary),
        "daily_table": daily_table(summary),
        "vehicle_series": vehicle_series(summary),
        "vehicle_table": vehicle_table(summary),
        "driver_series": driver_bars(summary),
        "driver_table": driver_table(summary),
        "captions": section_captions(summary),
        "status": section_status(summary),
        "headings": headings(summary.fine.sparkSession),
        "input_checks": input_checks(summary),
    }


def build_report(source: MeasureSource, cover: Cover) -> dict[str, DataFrame]:
    """All sections in report order.

    The source is read once, into a staged summary from which every section is computed. If its scope is
    the plant, each section but the headings holds the rows of all plants, told by that column; plants
    without trips have none.
    """
    summary = TripSummary(source)
    header = plant_headers if source.scope else report_header
    return {"header": header(summary, cover), **_sections(summary)}


def _cover(star: StarTables, site: int | None, start: str | None, end: str | None) -> Cover:
    month = default_period(instant(datetime.now()))
    first, last = (
        parse_instant(F.lit(text).cast("string"), default)
        for text, default in zip((start, end), month, strict=True)
    )
    return Cover(
        star.sites, site, first, last, id_column=star.columns.site_id, name_column=star.columns.site_name
    )


def run_report(
    star: StarTables,
    site: int,
    start: str | None = None,
    end: str | None = None,
    output: str | None = None,
    fmt: str = "parquet",
) -> str:
    """Write the report of one site; without a period, that of the current month.

    ``start`` and ``end`` are ``YYYY-MM-DD HH:MM:SS`` texts. Loads are aggregated before they are
    joined, so only the combinations of tag, reader, driver and day meet the dimensions. Intermediate
    tables are removed once the report is written. The report replaces that in ``output`` when it is
    complete; the folder of this version is returned, and ``publish.read_section`` finds the latest.
    """
    cover = _cover(star, site, start, end)
    with staging_run(star.loads.sparkSession):
        sections = build_report(star.cube(site, cover.start, cover.end), cover)
        return publish_report(sections, output or DEFAULT_OUTPUT, fmt)


def run_plant_reports(
    star: StarTables,
    start: str | None = None,
    end: str | None = None,
    output: str | None = None,
    fmt: str = "parquet",
    plants: Sequence[int] | None = None,
) -> str:
    """Write the reports of all plants, or of ``plants``, from one pass over the loads.

    Every section is partitioned by ``plant``, so the report of one plant is a folder of each; all are
    published together. Otherwise as :func:`run_report`.
    """
    cover = _cover(star, None, start, end)
    if plants is not None:
        star = replace(star, loads=star.loads.filter(F.col(star.columns.plant).isin(*plants)))
    with staging_run(star.loads.sparkSession):
        sections = build_report(star.cube(None, cover.start, cover.end, by_plant=True), cover)
        return publish_report(sections, output or DEFAULT_OUTPUT, fmt, partition_by="plant")
