"""The result each query must have, as DuckDB SQL over the same tables."""

from __future__ import annotations

# Fixed values, stated here again so that a wrong one in the library is found.
SITE = 3
PLANTS = range(1, 8)
PERIOD = ("1996-01-01 00:00:00", "1996-12-31 23:59:59")
EVENT_PERIOD = ("2024-01-05 06:00:00", "2024-01-12 18:30:00")
DEFAULT_INSTANT = "2024-01-01 00:00:00"
LABEL_WIDTH = 25
PARTICLES = ("da", "de", "do", "das", "dos", "e", "di", "du", "del", "van", "von", "d")
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
MEAN_LOAD = "Peso Médio (t/viagem)"
COLUMN_TITLES = {
    "daily_table": (
        ("data", "Data"),
        ("caminhoes", "Caminhões"),
        ("n_viagens", "Nº Viagens"),
        ("total", "Total (t)"),
        ("t_viagem", "t/Viagen"),
        ("primeira", "Primeira viagem"),
        ("ultima", "Última viagem"),
    ),
    "vehicle_table": (
        ("caminhao", "Caminhão"),
        ("n_viagens", "N° de Viagens"),
        ("total", "Total (t)"),
        ("peso_medio", MEAN_LOAD),
    ),
    "driver_table": (
        ("motorista", "Motorista"),
        ("n_viagens", "N° de Viagens"),
        ("total", "Total (t)"),
        ("peso_medio", MEAN_LOAD),
        ("media_dia", "Média (t/dia)"),
    ),
}
NO_ROWS = "Sem registros no período."
NO_POINTS = "Sem dados no período"
DAILY_PAGE, VEHICLE_PAGE, DRIVER_PAGE = 48, 38, 38
PRIMARY_SITE = "SÃO JOÃO"

STAR = """
SELECT l.l_shipdate AS time, p.p_brand AS vehicle, f.c_name AS driver, l.l_quantity AS volume,
       n.n_name AS site
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier sr ON sr.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = sr.s_nationkey
LEFT JOIN orders mr ON mr.o_orderkey = l.l_orderkey
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) f ON f.c_custkey = mr.o_custkey
"""


def star_selected(site: int) -> str:
    return f"""{STAR}
WHERE l.l_linenumber = {site} AND l.l_shipdate BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'
"""


STAR_SELECTED = star_selected(SITE)
CLEAN = """
SELECT event_id, ts AS time, event_type AS vehicle, concat('user ', user_id) AS driver,
       CAST(floor(value) AS DOUBLE) AS volume, 'A' AS site
FROM events
"""
DIRTY = """
SELECT event_id,
  CASE WHEN event_id % 29 = 0 THEN NULL ELSE ts END AS time,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN '  '
       WHEN event_id % 7 = 0 THEN concat(' ', upper(event_type)) ELSE event_type END AS vehicle,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '' WHEN event_id % 37 = 0 THEN '   '
       WHEN event_id % 2 = 0 THEN concat('MARIA-D''AVILA  DA SILVA ', CAST(user_id % 12 AS VARCHAR))
       ELSE concat('maria-d''avila da silva ', CAST(user_id % 12 AS VARCHAR)) END AS driver,
  CASE WHEN event_id % 11 = 0 THEN 'abc' WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '1d'
       WHEN event_id % 43 = 0 THEN 'nan' WHEN event_id % 5 = 0 THEN '0'
       ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS volume,
  'A' AS site
FROM events
"""

BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
NUMBER = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


# Expressions


def number(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{NUMBER}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


def r2(value: str) -> str:
    return f"round_even(CAST({value} AS DOUBLE) * 100, 0) / 100"


def ratio(total: str, count: str) -> str:
    return f"CASE WHEN {count} > 0 THEN {total} / {count} ELSE 0.0 END"


def ptbr(value: str) -> str:
    return f"translate(format('{{:,.2f}}', CAST({value} AS DOUBLE)), ',.', '.,')"


def dmy(moment: str) -> str:
    return f"strftime({moment}, '%d/%m/%Y')"


def dash(text: str) -> str:
    return f"CASE WHEN {text} <> '' THEN {text} ELSE '-' END"


def words(text: str) -> str:
    return f"list_filter(string_split(regexp_replace({text}, '{BLANKS}', ' ', 'g'), ' '), lambda w: w <> '')"


def upper_char(char: str) -> str:
    """Upper case of one character. The sharp s has a two-letter capital, which DuckDB's ``upper``
    does not produce."""
    return f"CASE WHEN {char} = 'ß' THEN 'SS' ELSE upper({char}) END"


def titlecase(text: str, elided: bool = True) -> str:
    particles = ", ".join(f"'{p}'" for p in PARTICLES)
    first = f"({upper_char('substring(p, 1, 1)')}) || substring(p, 2)"
    if elided:
        first = (
            "CASE WHEN starts_with(p, 'd''') AND length(p) > 2 "
            f"THEN 'd''' || ({upper_char('substring(p, 3, 1)')}) || substring(p, 4) ELSE {first} END"
        )
    hyphened = f"array_to_string(list_transform(string_split(w, '-'), lambda p: {first}), '-')"
    word = f"CASE WHEN i > 1 AND w IN ({particles}) THEN w ELSE {hyphened} END"
    source = words(f"lower(coalesce({text}, ''))")
    return f"array_to_string(list_transform({source}, lambda w, i: {word}), ' ')"


def label_table(driver: str) -> str:
    return titlecase(f"(CASE WHEN coalesce({driver}, '') = '' THEN 'não definido' ELSE {driver} END)")


def label_series(driver: str) -> str:
    return f"coalesce(nullif({titlecase(driver)}, ''), 'Não Definido')"


def wrap(text: str) -> str:
    width = LABEL_WIDTH
    fits = f"a.used + 1 + x.len <= {width}"
    entries = (
        f"list_transform({words(text)}, "
        "lambda w, i: {'used': -1, 'taken': CAST([] AS BIGINT[]), 'len': length(w), 'pos': i})"
    )
    folded = (
        f"list_reduce({entries}, lambda a, x: "
        f"{{'used': CASE WHEN {fits} THEN a.used + 1 + x.len ELSE a.used END, "
        f"'taken': CASE WHEN {fits} THEN list_append(a.taken, x.pos) ELSE a.taken END, "
        "'len': x.len, 'pos': x.pos}, "
        "{'used': -1, 'taken': CAST([] AS BIGINT[]), 'len': CAST(0 AS BIGINT), 'pos': CAST(0 AS BIGINT)})"
    )
    line = "array_to_string(list_filter({0}, lambda w, i: {1} list_contains(taken, i)), ' ')"
    first, second = line.format(words(text), ""), line.format(words(text), "NOT")
    return f"""
      CASE WHEN length({text}) <= {width} THEN {text}
           WHEN len({words(text)}) > 1
           THEN (SELECT {first} || chr(10) || {second} FROM (SELECT ({folded}).taken AS taken))
           ELSE substring({text}, 1, {width - 3}) || '...' END"""


# Exact sums, from the same integer parts of every volume

FRACTIONAL = """
SELECT l_shipdate AS time, CAST(l_shipdate AS DATE) AS day, concat('T', l_partkey % 97) AS vehicle,
       concat('driver ', l_suppkey % 31) AS driver,
       CASE WHEN l_linenumber = 7 THEN -net ELSE net END AS volume
FROM (SELECT *, l_extendedprice * (1 - l_discount) / 7 AS net FROM lineitem)
"""
PART = 4194304


def exact_totals(key: str | None) -> str:
    """Count and exact volume by ``key``: whole tons and three fractions of 22 bits, summed as integers."""
    carried = "{0} - (({0} % {1}) + {1}) % {1}"
    steps = [f"SELECT *, CASE WHEN volume < 0 THEN -1 ELSE 1 END AS sgn, abs(volume) AS left0 FROM ({FRACTIONAL})"]
    for i in range(4):
        steps.append(
            f"SELECT *, CAST(sgn * floor(left{i}) AS HUGEINT) AS part{i}, (left{i} - floor(left{i})) * {PART}.0 AS left{i + 1} FROM ({{}})"
        )
    group = key or "1"
    steps.append(
        f"SELECT {group} AS key, count(*) AS n_loads, "
        + ", ".join(f"sum(part{i}) AS s{i}" for i in range(4))
        + f" FROM ({{}}) GROUP BY {group}"
    )
    for i in (3, 2, 1):
        up = carried.format(f"s{i}", PART)
        others = ", ".join(f"s{j}" for j in range(i - 1))
        steps.append(
            f"SELECT key, n_loads, {others + ', ' if others else ''}s{i - 1} + ({up}) // {PART} AS s{i - 1}, "
            f"CAST(s{i} - ({up}) AS DOUBLE) AS d{i}"
            + "".join(f", d{j}" for j in range(i + 1, 4))
            + " FROM ({})"
        )
    steps.append(
        "SELECT key, n_loads, 0.0::DOUBLE + d3 * pow(2.0, -66) + d2 * pow(2.0, -44) + d1 * pow(2.0, -22)"
        " + CAST(s0 AS DOUBLE) AS volume FROM ({})"
    )
    sql = steps[0]
    for step in steps[1:]:
        sql = step.format(sql)
    return sql


def exact_kpis() -> str:
    return f"""
    WITH days AS ({exact_totals("day")}), vehicles AS ({exact_totals("vehicle")}), drivers AS ({exact_totals("driver")})
    SELECT volume AS total, n_loads AS n_trips,
           (SELECT key FROM vehicles ORDER BY volume DESC, key LIMIT 1) AS top_vehicle,
           (SELECT 'D' || key[2:] FROM drivers ORDER BY volume DESC, key LIMIT 1) AS top_driver,
           volume / (SELECT count(*) FROM days) AS mean_per_day,
           (SELECT key FROM days ORDER BY volume DESC, key LIMIT 1) AS best_day,
           (SELECT key FROM days WHERE volume > 0 ORDER BY volume, key LIMIT 1) AS worst_day,
           (SELECT count(*) FROM days) AS active_days
    FROM ({exact_totals(None)})
    """


# Queries over a trip relation


def trips(rows: str, body: str, *more: tuple[str, str]) -> str:
    """``body`` with the relation ``t``: trips with day and numeric volume."""
    volume = number("volume") if rows is DIRTY else "volume"
    ctes = [
        ("raw", rows),
        ("t", f"SELECT time, CAST(time AS DATE) AS day, vehicle, driver, {volume} AS volume, site FROM raw"),
        *more,
    ]
    listed = ", ".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {listed} {body}"


SPAN = "min(time) AS first_time, max(time) AS last_time"

DAYS = (
    "days",
    f"""
    SELECT d.*, coalesce(l.vehicles, '') AS vehicles
    FROM (SELECT day, count(*) AS n_trips, sum(coalesce(volume, 0)) AS v, {SPAN}
          FROM t WHERE day IS NOT NULL GROUP BY day) d
    LEFT JOIN (SELECT day, string_agg(name, ', ' ORDER BY lower(name), name) AS vehicles
               FROM (SELECT DISTINCT day, trim(vehicle) AS name FROM t WHERE trim(vehicle) <> '')
               GROUP BY day) l ON l.day = d.day
    """,
)
VEHICLES = (
    "vehicles",
    """
    SELECT coalesce(vehicle, '') AS vehicle, count(volume) AS n_loads, coalesce(sum(volume), 0) AS v
    FROM t GROUP BY ALL
    """,
)
DRIVERS = (
    "drivers",
    f"""
    SELECT label AS driver, count(volume) AS n_loads, coalesce(sum(volume), 0) AS v,
           count(DISTINCT CASE WHEN volume > 0 THEN day END) AS active_days,
           count(CASE WHEN volume > 0 THEN 1 END) AS n_positive
    FROM (SELECT *, {label_table("driver")} AS label FROM t) GROUP BY label
    """,
)
DAY_TOTALS = ("day_totals", "SELECT day, sum(coalesce(volume, 0)) AS v FROM t WHERE day IS NOT NULL GROUP BY day")
MEAN_PER_DAY = r2(ratio(r2("v"), "active_days"))


def daily(rows: str) -> str:
    return trips(
        rows,
        f"""SELECT day, n_trips, {r2("v")} AS total, {r2("v / n_trips")} AS mean_load, vehicles,
                   first_time, last_time FROM days""",
        DAYS,
    )


def vehicle(rows: str) -> str:
    mean = r2(ratio("v", "n_loads"))
    return trips(
        rows, f"SELECT vehicle, n_loads, {r2('v')} AS total, {mean} AS mean_load FROM vehicles", VEHICLES
    )


def driver(rows: str) -> str:
    mean = r2(ratio("v", "n_loads"))
    return trips(
        rows,
        f"""SELECT driver, n_loads, {r2("v")} AS total, {mean} AS mean_load, active_days,
                   {MEAN_PER_DAY} AS mean_per_day FROM drivers""",
        DRIVERS,
    )


def top(rows: str, key: str) -> str:
    """One row with the key of the largest total, null if there is none."""
    winner = f"""(SELECT {key} FROM t WHERE {key} IS NOT NULL GROUP BY {key}
                  ORDER BY sum(coalesce(volume, 0)) DESC, {key} LIMIT 1)"""
    return trips(
        rows,
        f"SELECT coalesce(k, '') AS {key}, {titlecase('k', elided=False)} AS top_{key} FROM (SELECT {winner} AS k)",
    )


def kpi_body() -> str:
    def winner(key: str) -> str:
        return f"""(SELECT {key} FROM t WHERE {key} IS NOT NULL GROUP BY {key}
                    ORDER BY sum(coalesce(volume, 0)) DESC, {key} LIMIT 1)"""

    return f"""
    SELECT total, n_trips, {titlecase("v", elided=False)} AS top_vehicle,
           {titlecase("d", elided=False)} AS top_driver,
           {ratio("total", "active_days")} AS mean_per_day, best_day, worst_day, active_days
    FROM (SELECT (SELECT coalesce(sum(volume), 0) FROM t) AS total,
                 (SELECT count(*) FROM t) AS n_trips,
                 (SELECT count(DISTINCT day) FROM t) AS active_days,
                 {winner("vehicle")} AS v, {winner("driver")} AS d,
                 (SELECT day FROM day_totals ORDER BY v DESC, day LIMIT 1) AS best_day,
                 (SELECT day FROM day_totals WHERE v > 0 ORDER BY v, day LIMIT 1) AS worst_day)
    """


def kpis(rows: str) -> str:
    return trips(rows, kpi_body(), DAY_TOTALS)


def cards(rows: str) -> str:
    texts = [
        ptbr("total"),
        "CAST(n_trips AS VARCHAR)",
        dash("top_vehicle"),
        dash("top_driver"),
        ptbr("mean_per_day"),
        f"coalesce({dmy('best_day')}, '-') || chr(10) || coalesce({dmy('worst_day')}, '-')",
    ]
    cards = " UNION ALL ".join(
        f"SELECT {i} AS position, '{title}' AS title, {text} AS value FROM k"
        for i, (title, text) in enumerate(zip(CARD_TITLES, texts, strict=True), start=1)
    )
    return trips(rows, cards, DAY_TOTALS, ("k", kpi_body()))


def pages(order: str, size: int) -> str:
    rank = f"(row_number() OVER (ORDER BY {order}) - 1)"
    return f"{rank} // {size} + 1 AS page_no, {rank} % {size} + 1 AS row_in_page"


def paged(rows: str, cte: tuple[str, str], key: str, order: str, size: int) -> str:
    return trips(rows, f"SELECT {key}, {r2('v')} AS total, {pages(order, size)} FROM {cte[0]}", cte)


def heading(section: str) -> str:
    title = SECTION_TITLES[section]
    period = f"coalesce((SELECT ': de ' || {dmy('min(time)')} || ' a ' || {dmy('max(time)')} FROM t), '')"
    return f"CASE WHEN page_no = 1 THEN '{title}' ELSE '{title} (continuação)' END || {period} AS section_title"


def display(rows: str, cte: tuple[str, str], columns: str, order: str, size: int, section: str) -> str:
    inner = f"SELECT {columns}, {pages(order, size)} FROM {cte[0]}"
    return trips(rows, f"SELECT *, {heading(section)} FROM ({inner})", cte)


def daily_display(rows: str) -> str:
    columns = f"""{dmy("day")} AS data, {dash("vehicles")} AS caminhoes,
        CAST(n_trips AS VARCHAR) AS n_viagens, {ptbr(r2("v"))} AS total,
        {ptbr(r2("v / n_trips"))} AS t_viagem, strftime(first_time, '%H:%M') AS primeira,
        strftime(last_time, '%H:%M') AS ultima"""
    return display(rows, DAYS, columns, "day", DAILY_PAGE, "daily_table")


def vehicle_display(rows: str) -> str:
    columns = f"""vehicle AS caminhao, CAST(n_loads AS VARCHAR) AS n_viagens,
        {ptbr(r2("v"))} AS total, {ptbr(r2(ratio("v", "n_loads")))} AS peso_medio"""
    return display(rows, VEHICLES, columns, "v DESC, vehicle", VEHICLE_PAGE, "vehicle_table")


def driver_display(rows: str) -> str:
    columns = f"""driver AS motorista, CAST(n_loads AS VARCHAR) AS n_viagens,
        {ptbr(r2("v"))} AS total, {ptbr(r2(ratio("v", "n_loads")))} AS peso_medio,
        CASE WHEN {MEAN_PER_DAY} > 0 THEN {ptbr(MEAN_PER_DAY)} ELSE '' END AS media_dia"""
    return display(rows, DRIVERS, columns, "v DESC, driver", DRIVER_PAGE, "driver_table")


def driver_totals(rows: str, columns: str) -> str:
    totals = "SELECT coalesce(driver, '') AS driver_raw, coalesce(sum(volume), 0) AS total FROM t GROUP BY ALL"
    return trips(rows, f"SELECT {columns} FROM (SELECT *, {label_series('driver_raw')} AS label FROM ({totals}))")


def section_counts(rows: str) -> list[tuple[str, str, str]]:
    """Section, SQL for its number of rows, and SQL for the rows whose absence empties it."""
    days = "(SELECT count(DISTINCT day) FROM t)"
    every = "(SELECT count(*) FROM t)"
    return [
        ("daily_series", days, days),
        ("daily_table", days, days),
        ("vehicle_series", "(SELECT count(DISTINCT vehicle) FROM t)", every),
        ("vehicle_table", "(SELECT count(DISTINCT coalesce(vehicle, '')) FROM t)", every),
        ("driver_series", "(SELECT count(DISTINCT coalesce(driver, '')) FROM t)", every),
        ("driver_table", f"(SELECT count(DISTINCT {label_table('driver')}) FROM t)", every),
    ]


def status(rows: str) -> str:
    def notice(section: str) -> str:
        return NO_ROWS if section.endswith("_table") else NO_POINTS

    return trips(
        rows,
        " UNION ALL ".join(
            f"SELECT '{section}' AS section, {count} AS n_rows, "
            f"CASE WHEN {emptied_by} = 0 THEN '{notice(section)}' END AS message"
            for section, count, emptied_by in section_counts(rows)
        ),
    )


def headings() -> str:
    pages = [(section, 0, "", title) for section, title in PAGE_TITLES.items()]
    columns = [(s, i, c, t) for s, titles in COLUMN_TITLES.items() for i, (c, t) in enumerate(titles, start=1)]
    return " UNION ALL ".join(
        f"SELECT 'headings' AS section, CAST(0 AS BIGINT) AS page, CAST(0 AS BIGINT) AS row, '{'|'.join(map(str, entry))}' AS texts"
        for entry in pages + columns
    )


def written_report(rows: str, site: int = SITE) -> str:
    """All rows of a report in long form: section, page, row in the page, and joined texts."""

    def part(section: str, sql: str, columns: str, paged_rows: bool = False) -> str:
        texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns.split("; "))
        place = "page_no AS page, row_in_page AS row" if paged_rows else "CAST(0 AS BIGINT) AS page, CAST(0 AS BIGINT) AS row"
        return f"SELECT '{section}' AS section, {place}, concat_ws('|', {texts}) AS texts FROM ({sql})"

    day_label, total = "strftime(day, '%Y-%m-%d')", ptbr("total")
    vehicles = "SELECT vehicle, coalesce(sum(volume), 0) AS total FROM t WHERE vehicle IS NOT NULL GROUP BY ALL"
    points = "SELECT day, v AS total, format('{:,.0f}', v) AS label FROM day_totals"
    bars = driver_totals(rows, f"driver_raw, label, {wrap('label')} AS label_wrapped, total")
    heading_of = "section_title"
    return " UNION ALL ".join(
        [
            part("header", header(rows, site), "title; company; period; brand; generated_by; console_line"),
            part("kpi_cards", cards(rows), "position; title; value"),
            part("daily_series", trips(rows, points, DAY_TOTALS), f"{day_label}; label; {total}"),
            part(
                "daily_table",
                daily_display(rows),
                f"data; caminhoes; n_viagens; total; t_viagem; primeira; ultima; {heading_of}",
                True,
            ),
            part("vehicle_series", trips(rows, vehicles), f"vehicle; {total}"),
            part(
                "vehicle_table",
                vehicle_display(rows),
                f"caminhao; n_viagens; total; peso_medio; {heading_of}",
                True,
            ),
            part("driver_series", bars, f"driver_raw; label; label_wrapped; {total}"),
            part(
                "driver_table",
                driver_display(rows),
                f"motorista; n_viagens; total; peso_medio; media_dia; {heading_of}",
                True,
            ),
            part("captions", captions(rows), "section; caption"),
            part("status", status(rows), "section; n_rows; message"),
        ]
    )


def ranked_by_total(rows: str, cte: tuple[str, str], key: str) -> str:
    rank = f"row_number() OVER (ORDER BY v DESC, {key})"
    return trips(rows, f"SELECT {key}, {r2('v')} AS total, {rank} AS rank FROM {cte[0]}", cte)


def key_checks() -> str:
    keys = {
        "vehicles": ("part", "p_partkey"),
        "readers": ("supplier", "s_suppkey"),
        "sites": ("nation", "n_nationkey"),
        "drivers": ("orders", "o_orderkey"),
        "employees": ("(SELECT * FROM customer WHERE c_acctbal >= 0)", "c_custkey"),
    }
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS dimension, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_keys,
                   count(CASE WHEN n > 1 THEN 1 END) AS n_repeated
            FROM (SELECT {key}, count(*) AS n FROM {source} WHERE {key} IS NOT NULL GROUP BY {key})"""
        for name, (source, key) in keys.items()
    )


def input_checks() -> str:
    counts = {
        "trips": "true",
        "times_unreadable": "false",
        "times_missing": "time IS NULL",
        "volumes_unreadable": f"volume IS NOT NULL AND ({number('volume')}) IS NULL OR lower(volume) = 'nan'",
        "volumes_missing": "volume IS NULL",
        "vehicles_without_name": "coalesce(trim(vehicle), '') = ''",
        "drivers_without_name": "coalesce(trim(driver), '') = ''",
    }
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check, count(*) AS n FROM ({DIRTY}) WHERE {condition}" for check, condition in counts.items()
    )


def match_checks() -> str:
    return """
      SELECT 'vehicles' AS dimension, count(*) AS n_loads, CAST(0 AS BIGINT) AS n_without_id,
             count(*) FILTER (WHERE l_partkey % 5 = 0 OR p_partkey IS NULL) AS n_unmatched
      FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
      UNION ALL
      SELECT 'readers', count(*), 0, count(*) FILTER (WHERE l_suppkey % 5 = 0 OR s_suppkey IS NULL)
      FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
      UNION ALL
      SELECT 'drivers', count(*), count(*) FILTER (WHERE l_orderkey % 3 = 0),
             count(*) FILTER (WHERE l_orderkey % 3 <> 0 AND o_orderkey IS NULL)
      FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey"""


def captions(rows: str) -> str:
    return trips(
        rows,
        " UNION ALL ".join(
            f"""SELECT '{section}' AS section,
                       coalesce('{title}: de ' || {dmy("min(time)")} || ' a ' || {dmy("max(time)")}, '') AS caption
                FROM t"""
            for section, title in SECTION_TITLES.items()
        ),
    )


def header(rows: str, plant: int) -> str:
    start, end = (f"TIMESTAMP '{p}'" for p in PERIOD)
    company = f"coalesce((SELECT max(n_name) FROM nation WHERE n_nationkey = {plant}), 'Obra {plant}')"
    site = "(SELECT site FROM t WHERE time IS NOT NULL ORDER BY time, site NULLS FIRST LIMIT 1)"
    return trips(
        rows,
        f"""SELECT '{TITLE}' AS title, {company} AS company,
                   'De ' || {dmy(start)} || ' a ' || {dmy(end)} AS period,
                   CASE WHEN {site} = '{PRIMARY_SITE}' THEN 'A' ELSE 'B' END AS brand,
                   'tripmill' AS generated_by,
                   'Relatório: ' || {company} || ' | Período: {PERIOD[0]} a {PERIOD[1]}' AS console_line""",
    )


def on_documents(expression: str, name: str) -> str:
    return f"SELECT doc_id, {expression} AS {name} FROM documents"


def all_oracles() -> dict[str, str]:
    net = "l_extendedprice * (1 - l_discount)"
    day_total = "SELECT day, v AS total FROM day_totals"
    in_event_period = f"""SELECT event_id, ts, event_type FROM events
        WHERE ts BETWEEN TIMESTAMP '{EVENT_PERIOD[0]}' AND TIMESTAMP '{EVENT_PERIOD[1]}'"""
    return {
        "src_param_sql": STAR_SELECTED,
        "trip_extract": STAR_SELECTED,
        "site_name_lookup": " UNION ALL ".join(
            f"""SELECT {i} AS site_id, coalesce((SELECT max(s_name) FROM supplier
                WHERE s_suppkey = {i}), 'Obra {i}') AS site_name"""
            for i in (SITE, -1)
        ),
        "extract_from": f"{STAR} WHERE l.l_shipdate >= TIMESTAMP '{PERIOD[0]}'",
        "extract_until": f"{STAR} WHERE l.l_shipdate <= TIMESTAMP '{PERIOD[1]}'",
        "key_check": key_checks(),
        "sink_roundtrip": written_report(STAR_SELECTED),
        "run_report": written_report(STAR_SELECTED),
        "plant_reports": " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS plant, * FROM ({written_report(star_selected(i), i)})" for i in PLANTS
        ),
        "published_report": f"{written_report(STAR_SELECTED)} UNION ALL {headings()}",
        "filter_site": f"""SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
                           WHERE l_linenumber = {SITE}""",
        "filter_period": in_event_period,
        "filter_period_by_day": in_event_period,
        "filter_period_by_instant": in_event_period,
        "filter_period_by_text": in_event_period,
        "extract_by_month": STAR_SELECTED,
        "parse_period": f"""SELECT event_id, CASE WHEN event_type IN ('error', 'click')
            THEN TIMESTAMP '{DEFAULT_INSTANT}' ELSE date_trunc('second', ts) END AS instant FROM events""",
        "default_period": """SELECT event_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS period_start,
            CAST(date_trunc('month', ts) AS TIMESTAMP) + INTERVAL 1 MONTH - INTERVAL 1 SECOND AS period_end
            FROM events""",
        "ensure_columns": f"""SELECT time, driver, '' AS vehicle, '' AS site, CAST(0 AS DOUBLE) AS volume
            FROM ({CLEAN})""",
        "coerce_volume_zero": f"SELECT event_id, coalesce({number('volume')}, 0) AS volume FROM ({DIRTY})",
        "coerce_volume_null": f"SELECT event_id, {number('volume')} AS volume FROM ({DIRTY})",
        "coerce_time": """SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL
            WHEN event_type = 'click' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE ts END AS time FROM events""",
        "fill_text": f"""SELECT event_id, coalesce(vehicle, '') AS vehicle, coalesce(driver, '') AS driver
            FROM ({DIRTY})""",
        "driver_label_table": f"SELECT event_id, {label_table('driver')} AS label FROM ({DIRTY})",
        "driver_label_series": f"SELECT event_id, {label_series('driver')} AS label FROM ({DIRTY})",
        "join_vehicle": """SELECT l_orderkey, l_linenumber, p_brand AS vehicle FROM lineitem
            JOIN part ON l_partkey = p_partkey""",
        "join_reader_site": """SELECT l_orderkey, l_linenumber, n_name AS site FROM lineitem
            JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
        "join_driver_left": """SELECT l_orderkey, l_linenumber, c_name AS driver FROM lineitem
            LEFT JOIN orders ON o_orderkey = l_orderkey
            LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey""",
        "join_driver_nulls": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END AS entry,
            CASE WHEN l_orderkey % 3 <> 0 THEN c_name END AS driver FROM lineitem
            LEFT JOIN orders ON o_orderkey = l_orderkey
            LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey""",
        "join_heavy_keys": """
            WITH loads AS (
              SELECT l_orderkey AS load_order, l_linenumber, (l_orderkey + l_linenumber) % 3 AS rest,
                     l_partkey, l_suppkey, l_orderkey FROM lineitem)
            SELECT load_order, l_linenumber, p_brand AS vehicle, n_name AS site, c_name AS driver FROM loads
            JOIN part ON p_partkey = CASE WHEN rest = 0 THEN 1 ELSE l_partkey END
            JOIN supplier ON s_suppkey = CASE WHEN rest = 1 THEN 1 ELSE l_suppkey END
            JOIN nation ON n_nationkey = s_nationkey
            LEFT JOIN orders ON o_orderkey = CASE WHEN rest = 2 THEN 1 ELSE l_orderkey END
            LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON c_custkey = o_custkey""",
        "active_days": trips(CLEAN, "SELECT count(DISTINCT day) AS active_days FROM t"),
        "active_days_dirty": trips(DIRTY, "SELECT count(DISTINCT day) AS active_days FROM t"),
        "daily_production": daily(CLEAN),
        "daily_production_dirty": daily(DIRTY),
        "daily_production_cube": daily(STAR),
        "daily_vehicle_rows": trips(
            DIRTY,
            """SELECT day, trim(vehicle) AS vehicle, count(*) AS n_trips FROM t
               WHERE day IS NOT NULL AND trim(vehicle) <> '' GROUP BY ALL""",
        ),
        "input_checks": input_checks(),
        "match_check": match_checks(),
        "daily_vehicle_chunks": trips(
            DIRTY,
            """SELECT day, place // 3 + 1 AS chunk, count(*) AS n_vehicles, string_agg(name, ', ' ORDER BY place) AS vehicles
               FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY lower(name), name) - 1 AS place
                     FROM (SELECT DISTINCT day, trim(vehicle) AS name FROM t WHERE day IS NOT NULL AND trim(vehicle) <> ''))
               GROUP BY ALL""",
        ),
        "daily_vehicle_list": trips(DIRTY, "SELECT day, vehicles FROM days", DAYS),
        "vehicle_production": vehicle(STAR),
        "vehicle_production_cube": vehicle(STAR),
        "vehicle_ranking": ranked_by_total(STAR, VEHICLES, "vehicle"),
        "vehicle_production_dirty": vehicle(DIRTY),
        "driver_production": driver(STAR),
        "driver_production_cube": driver(STAR),
        "driver_ranking": ranked_by_total(STAR, DRIVERS, "driver"),
        "driver_production_dirty": driver(DIRTY),
        "driver_half_periods": driver(DIRTY),
        "driver_active_days": trips(
            DIRTY, "SELECT driver, active_days FROM drivers WHERE n_positive > 0", DRIVERS
        ),
        "daily_series": trips(DIRTY, day_total, DAY_TOTALS),
        "vehicle_series": trips(
            DIRTY,
            "SELECT vehicle, coalesce(sum(volume), 0) AS total FROM t WHERE vehicle IS NOT NULL GROUP BY ALL",
        ),
        "driver_series": driver_totals(DIRTY, "driver_raw, label, total"),
        "observed_period": trips(DIRTY, f"SELECT {SPAN} FROM t"),
        "days_positive": trips(DIRTY, f"{day_total} WHERE v > 0", DAY_TOTALS),
        "top_vehicle": top(DIRTY, "vehicle"),
        "top_driver": top(STAR, "driver"),
        "top_driver_dirty": top(DIRTY, "driver"),
        "best_day": trips(
            STAR, "SELECT (SELECT day FROM day_totals ORDER BY v DESC, day LIMIT 1) AS best_day", DAY_TOTALS
        ),
        "worst_positive_day": trips(
            DIRTY,
            "SELECT (SELECT day FROM day_totals WHERE v > 0 ORDER BY v, day LIMIT 1) AS worst_day",
            DAY_TOTALS,
        ),
        "first_site": trips(
            STAR, "SELECT site FROM t WHERE time IS NOT NULL ORDER BY time, site NULLS FIRST LIMIT 1"
        ),
        "first_site_cube": trips(
            STAR, "SELECT site FROM t WHERE time IS NOT NULL ORDER BY time, site NULLS FIRST LIMIT 1"
        ),
        "exact_kpis": exact_kpis(),
        "exact_kpis_cube": exact_kpis(),
        "exact_daily_totals": f"SELECT key AS day, volume AS total FROM ({exact_totals('day')})",
        "exact_vehicle_totals": f"SELECT key AS vehicle, volume AS total FROM ({exact_totals('vehicle')})",
        "exact_driver_ranking": f"""SELECT 'D' || key[2:] AS driver, volume,
            {r2("volume / n_loads")} AS mean_load, row_number() OVER (ORDER BY volume DESC, key) AS rank
            FROM ({exact_totals('driver')})""",
        "kpi_summary": kpis(STAR),
        "kpi_summary_dirty": kpis(DIRTY),
        "paginate_daily": paged(STAR, DAYS, "day", "day", DAILY_PAGE),
        "paginate_vehicle": paged(STAR, VEHICLES, "vehicle", "v DESC, vehicle", VEHICLE_PAGE),
        "paginate_driver": paged(STAR, DRIVERS, "driver", "v DESC, driver", DRIVER_PAGE),
        "titlecase_pt": on_documents(titlecase("text"), "cased"),
        "titlecase_card": on_documents(titlecase("text", elided=False), "cased"),
        "wrap_label": on_documents(wrap("text"), "wrapped"),
        "round2": f"SELECT l_orderkey, l_linenumber, {r2(net)} AS rounded FROM lineitem",
        "format_ptbr": f"""SELECT l_orderkey, l_linenumber, {ptbr(net)} AS price_text,
            format('{{:,.0f}}', {net}) AS price_label FROM lineitem""",
        "format_dates": f"""SELECT event_id, {dmy("ts")} AS date_text, strftime(ts, '%H:%M') AS clock_text,
            strftime(ts, '%Y-%m-%d') AS iso_text FROM events""",
        "section_caption": captions(DIRTY),
        "report_header": header(STAR_SELECTED, SITE),
        "kpi_cards": cards(DIRTY),
        "report_daily_series": trips(
            DIRTY,
            f"""SELECT day, v AS total, format('{{:,.0f}}', v) AS label,
                       strftime(day, '%Y-%m-%d') AS day_label FROM day_totals""",
            DAY_TOTALS,
        ),
        "report_daily_table": daily_display(DIRTY),
        "report_vehicle_series": trips(
            STAR, "SELECT vehicle, sum(volume) AS total FROM t WHERE vehicle IS NOT NULL GROUP BY ALL"
        ),
        "report_vehicle_table": vehicle_display(DIRTY),
        "report_driver_series": driver_totals(
            STAR, f"driver_raw, label, {wrap('label')} AS label_wrapped, total"
        ),
        "report_driver_table": driver_display(STAR),
        "report_driver_table_dirty": driver_display(DIRTY),
        "section_status": status(DIRTY),
    }
