"""A dozen spoiled trips and what every rollup makes of them."""

from datetime import date

from tripmill import Roles, Trips

SCHEMA = "time string, vehicle string, driver string, volume string, site string"
SITE = "SÃO JOÃO"
ROWS = [
    ("2025-09-01 06:00:00", "TRK-100", "JOÃO DA SILVA", "20.125"),
    ("2025-09-01 07:30:00", "TRK-200", "joão  da silva", "30"),
    ("2025-09-01 18:45:10", "TRK-100", None, "abc"),
    ("2025-09-02 05:59:59", "TRK-300", "maria-joao", "25.5"),
    ("2025-09-02 08:00:00", " trk-050 ", "d'ávila", None),
    ("2025-09-02 09:00:00", None, "", "10"),
    ("2025-09-03 10:00:00", "TRK-300", "   ", "0"),
    ("2025-09-04 11:00:00", "TRK-200", "maria-joao", "24.625"),
    (None, "TRK-100", "JOÃO DA SILVA", "5"),
    ("2025-09-04 12:00:00", "", "não definido", "1.5"),
    ("2025-09-05 13:00:00", "TRK-200", "D'ÁVILA", "-2"),
    ("2025-09-05 14:00:00", "TRK-050", "ana", "NaN"),
]


def day(number: int) -> date:
    return date(2025, 9, number)


KPIS = {
    "total": 114.75,
    "n_trips": 12,
    "top_vehicle": "Trk-200",
    "top_driver": "Maria-Joao",
    "mean_per_day": 22.95,
    "best_day": day(1),
    "worst_day": day(4),
    "active_days": 5,
}
DAILY = [
    (day(1), 3, 50.12, 16.71, "TRK-100, TRK-200", "06:00", "18:45"),
    (day(2), 3, 35.5, 11.83, "trk-050, TRK-300", "05:59", "09:00"),
    (day(3), 1, 0.0, 0.0, "TRK-300", "10:00", "10:00"),
    (day(4), 2, 26.12, 13.06, "TRK-200", "11:00", "12:00"),
    (day(5), 2, -2.0, -1.0, "TRK-050, TRK-200", "13:00", "14:00"),
]
VEHICLES = [
    ("TRK-200", 3, 52.62, 17.54),
    ("TRK-300", 2, 25.5, 12.75),
    ("TRK-100", 2, 25.12, 12.56),
    ("", 2, 11.5, 5.75),
    (" trk-050 ", 0, 0.0, 0.0),
    ("TRK-050", 0, 0.0, 0.0),
]
VEHICLE_SERIES = [
    ("TRK-200", 52.625),
    ("TRK-300", 25.5),
    ("TRK-100", 25.125),
    ("", 1.5),
    (" trk-050 ", 0.0),
    ("TRK-050", 0.0),
]
DRIVERS = [
    ("João da Silva", 3, 55.12, 18.38, 1, 55.12),
    ("Maria-Joao", 2, 50.12, 25.06, 2, 25.06),
    ("Não Definido", 2, 11.5, 5.75, 2, 5.75),
    ("", 1, 0.0, 0.0, 0, 0.0),
    ("Ana", 0, 0.0, 0.0, 0, 0.0),
    ("d'Ávila", 1, -2.0, -2.0, 0, 0.0),
]
DRIVER_SERIES = [
    ("maria-joao", 50.125, "Maria-Joao"),
    ("joão  da silva", 30.0, "João da Silva"),
    ("JOÃO DA SILVA", 25.125, "João da Silva"),
    ("", 10.0, "Não Definido"),
    ("não definido", 1.5, "Não Definido"),
    ("   ", 0.0, "Não Definido"),
    ("ana", 0.0, "Ana"),
    ("d'ávila", 0.0, "d'Ávila"),
    ("D'ÁVILA", -2.0, "d'Ávila"),
]


def spoiled_frame(spark):
    return spark.createDataFrame([(*row, SITE) for row in ROWS], SCHEMA)


def trips_of(spark, rows):
    return Trips(spark.createDataFrame(rows, SCHEMA), Roles.plain())


def spoiled_trips(spark):
    return Trips(spoiled_frame(spark), Roles.plain())


def tuples(df):
    return [tuple(row) for row in df.collect()]
