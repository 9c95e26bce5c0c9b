"""Loads laid out by date: what a period means for the partition columns, and how to write such a copy.

A period on the time column alone lists and opens every file; text times are not even compared with the
statistics in the files. Where a table's folders tell the date, :class:`DayPartitions` derives a condition
on the partition columns from the period, which Spark answers from folder names or the catalogue.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.dates import instant, time_or_null

GRAINS = ("year", "month", "day")


@dataclass(frozen=True)
class DayPartitions:
    """The partition columns that tell the date of a load.

    One column holds dates, ISO texts (``2025-09-01``, ``2025-9``) or numbers (``20250901``, ``202509``,
    ``2025``), of the stated ``grain``. Several columns are year, month and day, as many as there are.
    ``slack_days`` widens the period for dates that were taken in another time zone than the session's; by
    default a day for TIMESTAMP times, which are instants, and none for others.
    """

    columns: tuple[str, ...] = ("day",)
    grain: str = "day"
    slack_days: int | None = None

    def __post_init__(self):
        if isinstance(self.columns, str) or not 1 <= len(self.columns) <= 3:
            raise ValueError("one column, or year, month and day")
        if self.grain not in GRAINS:
            raise ValueError(f"the grain is one of {', '.join(GRAINS)}")

    @property
    def finest(self) -> str:
        return self.grain if len(self.columns) == 1 else GRAINS[len(self.columns) - 1]

    def first_day(self, rows: DataFrame) -> Column:
        """First date of a partition, null where its name cannot be read as a date."""
        kinds = [rows.schema[c].dataType for c in self.columns]
        if isinstance(kinds[0], T.DateType):
            return F.col(self.columns[0])
        dash = F.lit("-")
        parts = [p for c in self.columns for p in (dash, F.col(c).cast("string"))][1:]
        text = F.concat(*parts)
        digits = F.rpad(text, 8, "01")
        spelled = F.concat(F.substring(digits, 1, 4), dash, F.substring(digits, 5, 2), dash, F.substring(digits, 7, 2))
        return F.when(text.rlike("^([0-9]{4}|[0-9]{6}|[0-9]{8})$"), spelled).otherwise(text).try_cast("date")

    def last_day(self, rows: DataFrame) -> Column:
        first = self.first_day(rows)
        if self.finest == "day":
            return first
        if self.finest == "month":
            return F.last_day(first)
        return F.last_day(F.add_months(F.trunc(first, "year"), 11))

    def within(
        self,
        rows: DataFrame,
        start: str | datetime | Column | None,
        end: str | datetime | Column | None,
        time: str,
    ) -> DataFrame:
        """``rows`` without the partitions that lie outside the period altogether.

        Partitions without a readable date stay, for the time itself to decide.
        """
        slack = self.slack_days
        if slack is None:
            slack = int(isinstance(rows.schema[time].dataType, T.TimestampType))
        if start is not None:
            last = self.last_day(rows)
            rows = rows.filter((last >= F.date_sub(F.to_date(instant(start)), slack)) | last.isNull())
        if end is not None:
            first = self.first_day(rows)
            rows = rows.filter((first <= F.date_add(F.to_date(instant(end)), slack)) | first.isNull())
        return rows


def write_by_date(
    loads: DataFrame, folder: str, partitions: DayPartitions = DayPartitions(), time: str = "time", spread_by: Sequence[str] = ()
) -> str:
    """Write ``loads`` to ``folder`` in the layout that ``partitions`` describes, and return the folder.

    Tasks get ranges of date and time, so that a date comes to a few files, each with a narrow range of
    times, and a crowded date to as many as it needs. Equal and unreadable times are told apart by
    ``spread_by``, by default all columns.
    """
    value = time_or_null(loads, time)
    date = F.to_date(value)
    if len(partitions.columns) == 1:
        text = date.cast("string")
        made = [{"day": text, "month": F.substring(text, 1, 7), "year": F.substring(text, 1, 4)}[partitions.grain]]
    else:
        made = [F.year(date), F.month(date), F.dayofmonth(date)][: len(partitions.columns)]
    dated = loads.withColumns(dict(zip(partitions.columns, made, strict=True)))
    keys = [*partitions.columns, value, F.xxhash64(*(spread_by or loads.columns))]
    dated.repartitionByRange(*keys).sortWithinPartitions(*keys[:-1]).write.partitionBy(*partitions.columns).parquet(folder)
    return folder
