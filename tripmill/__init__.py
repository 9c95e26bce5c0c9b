"""Production reporting over truck-load events, built on Spark DataFrames."""

from tripmill.operators.measures import TripCube, Trips, TripSummary
from tripmill.plans.report import Cover, build_report, run_report, write_report
from tripmill.schema import Roles, ensure_columns
from tripmill.sources.star import StarColumns, StarTables

__all__ = [
    "Cover",
    "Roles",
    "StarColumns",
    "StarTables",
    "TripCube",
    "TripSummary",
    "Trips",
    "build_report",
    "ensure_columns",
    "run_report",
    "write_report",
]
