"""Input and output of each column function."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripmill.functions import dates, numbers, text


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    found = rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in found]


def check(spark, function, pairs, kind="string"):
    assert apply(spark, function, [p[0] for p in pairs], kind) == [p[1] for p in pairs]


TITLES = [
    ("  JOÃO  DA silva", "João da Silva"),
    ("maria-joao", "Maria-Joao"),
    ("d'ávila", "d'Ávila"),
    ("ana d'", "Ana D'"),
    ("da costa", "Da Costa"),
    ("TRK-100", "Trk-100"),
    ("   ", ""),
    ("a--b", "A--B"),
    ("van d e", "Van d e"),
    ("maria-d'avila", "Maria-d'Avila"),
    ("ana\tmaria e rui", "Ana Maria e Rui"),
    ("ßa", "SSa"),
    (None, ""),
]


def test_titlecase(spark):
    check(spark, text.titlecase, TITLES)


def test_titlecase_is_stable(spark):
    once = [t for _, t in TITLES if t != "SSa"]
    assert apply(spark, text.titlecase, once) == once


def test_titlecase_card(spark):
    check(
        spark,
        text.titlecase_card,
        [("d'ávila", "D'ávila"), ("maria-d'avila", "Maria-D'avila"), ("ana DA silva", "Ana da Silva"), (None, "")],
    )


def test_driver_labels(spark):
    names = [None, "", "   ", "ANA", "não definido"]
    assert apply(spark, text.driver_label_table, names) == ["Não Definido", "Não Definido", "", "Ana", "Não Definido"]
    assert apply(spark, text.driver_label_series, names) == ["Não Definido"] * 3 + ["Ana", "Não Definido"]


def test_wrap_label(spark):
    check(
        spark,
        text.wrap_label,
        [
            ("Ana Silva", "Ana Silva"),
            ("Aaaaaaaaaaaaaaaaaaaa Bbbbbbbbbbbbbbb Cc", "Aaaaaaaaaaaaaaaaaaaa Cc\nBbbbbbbbbbbbbbb"),
            ("Abcdefghijklmnopqrstuvwxyzabc", "Abcdefghijklmnopqrstuv..."),
            ("Abcdefghijklmnopqrstuvwxyzabc De", "De\nAbcdefghijklmnopqrstuvwxyzabc"),
            ("Abcdefghijklmnopqrstuvwxyzabc Bcdefghijklmnopqrstuvwxyzabcd", "\nAbcdefghijklmnopqrstuvwxyzabc Bcdefghijklmnopqrstuvwxyzabcd"),
        ],
    )


def test_wrap_label_keeps_every_word_of_a_long_text(spark):
    long = " ".join(f"w{i}" for i in range(5000))
    (wrapped,) = apply(spark, text.wrap_label, [long])
    first, second = wrapped.split("\n")
    assert len(first) <= 25
    assert sorted((first + " " + second).split()) == sorted(long.split())


def test_strip_and_dash(spark):
    check(spark, text.strip, [(" a b ", "a b"), (" x\t", "x"), ("  ", "")])
    check(spark, text.dash_if_blank, [("", "-"), ("x", "x")])


def test_round2(spark):
    check(spark, numbers.round2, [(2.675, 2.68), (0.125, 0.12), (1.005, 1.0), (2.5, 2.5)], "double")


def test_number_text(spark):
    nan, inf = float("nan"), float("inf")
    check(
        spark,
        numbers.number_text,
        [
            (1234567.895, "1.234.567,90"),
            (0.125, "0,12"),
            (2.675, "2,67"),
            (-0.001, "-0,00"),
            (None, "0,00"),
            (nan, "0,00"),
            (inf, "0,00"),
        ],
        "double",
    )


def test_point_label(spark):
    check(
        spark,
        numbers.point_label,
        [(1234567.895, "1,234,568"), (0.5, "0"), (1.5, "2"), (2.5, "2")],
        "double",
    )


def test_parse_number(spark):
    good = [(" 12 ", 12.0), ("1e3", 1000.0), ("-0", 0.0), (".5", 0.5), ("5.", 5.0), ("+7", 7.0)]
    bad = ["abc", "", "0x10", "1_000", "1d", "1.5f", "nan", "NaN", "inf", "1e999", "1,5", None]
    check(spark, numbers.parse_number, good + [(b, None) for b in bad])


def test_number_columns_by_type(spark):
    rows = spark.createDataFrame([(1.5, 2, float("nan"), True)], "d double, i int, n double, b boolean")
    rows = rows.withColumn("m", F.lit("3.25").cast("decimal(9,2)"))
    found = rows.select(*[numbers.number_or_null(rows, c).alias(c) for c in ("d", "i", "n", "m")])
    assert tuple(found.first()) == (1.5, 2.0, None, 3.25)
    assert rows.select(numbers.number_or_zero(rows, "n")).first()[0] == 0.0


def test_parse_instant(spark):
    default = dates.instant("2020-01-01 00:00:00")

    def parse(value):
        return dates.parse_instant(value, default)

    check(
        spark,
        parse,
        [
            ("2025-8-1 0:0:0", datetime(2025, 8, 1)),
            ("2025-08-28 23:59:59", datetime(2025, 8, 28, 23, 59, 59)),
            ("", datetime(2020, 1, 1)),
            (None, datetime(2020, 1, 1)),
        ],
    )
    for bad in ("2025-09-30", "x", "2025-02-30 00:00:00", "2025-01-01 24:00:00"):
        with pytest.raises(PySparkException, match="Data inválida"):
            apply(spark, parse, [bad])
    with pytest.raises(PySparkException, match="Data inválida"):
        apply(spark, dates.parse_instant, [None])


def test_period_of_a_month(spark):
    moments = [datetime(2025, 2, 12, 3, 4, 5), datetime(2024, 2, 29), datetime(2025, 12, 31, 23, 59, 59)]
    assert apply(spark, dates.month_start, moments, "timestamp_ntz") == [
        datetime(2025, 2, 1),
        datetime(2024, 2, 1),
        datetime(2025, 12, 1),
    ]
    assert apply(spark, dates.month_end, moments, "timestamp_ntz") == [
        datetime(2025, 2, 28, 23, 59, 59),
        datetime(2024, 2, 29, 23, 59, 59),
        datetime(2025, 12, 31, 23, 59, 59),
    ]


def test_date_texts(spark):
    moment = [datetime(2025, 9, 1, 18, 45, 59)]
    assert apply(spark, dates.date_text, moment, "timestamp_ntz") == ["01/09/2025"]
    assert apply(spark, dates.clock_text, moment, "timestamp_ntz") == ["18:45"]
    assert apply(spark, dates.iso_date_text, moment, "timestamp_ntz") == ["2025-09-01"]


def test_span_text_is_blank_without_both_ends(spark):
    rows = spark.sql("SELECT timestamp_ntz'2025-09-01 00:00:00' AS a, cast(null as timestamp_ntz) AS b")
    found = rows.select(dates.span_text(F.col("a"), F.col("a")), dates.span_text(F.col("a"), F.col("b")))
    assert tuple(found.first()) == ("De 01/09/2025 a 01/09/2025", "")


def test_texts_do_not_depend_on_the_session_zone(spark):
    # Clocks in Sao Paulo skipped the first hour of this day.
    moment = [datetime(2018, 11, 4, 0, 30)]
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert apply(spark, dates.clock_text, moment, "timestamp_ntz") == ["00:30"]
        assert apply(spark, dates.date_text, moment, "timestamp_ntz") == ["04/11/2018"]
        assert apply(spark, dates.month_start, moment, "timestamp_ntz") == [datetime(2018, 11, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_generation_stamp_is_three_hours_behind(spark):
    row = spark.range(1).select(dates.generation_stamp().alias("stamp"), F.current_timestamp().alias("now"))
    found = row.select("stamp", F.date_format(F.col("now") - F.expr("INTERVAL 3 HOURS"), "dd/MM/yyyy HH:mm"))
    stamp, expected = found.first()
    assert stamp == expected
