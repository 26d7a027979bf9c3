"""Report dates, months and shift days."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsreport.operators.asof import latest_effective

# Fixed value: days to look back when no range is asked for.
DEFAULT_LOOK_BACK = 16

_GIVEN = re.compile(r"(?P<d>\d{1,2})\.(?P<m>\d{1,2})\.(?P<y>\d{4})|(?P<iso>\d{4}-\d{1,2}-\d{1,2})")


def argument_date(given: str | date) -> date:
    """A date as callers give it: dd.mm.yyyy, yyyy-mm-dd, or a date already."""
    if isinstance(given, date):
        return date(given.year, given.month, given.day)
    found = _GIVEN.fullmatch(given)
    if not found:
        raise ValueError(f"not a date in dd.mm.yyyy or yyyy-mm-dd: {given!r}")
    year, month, day = (found["iso"] or "-".join(found.group("y", "m", "d"))).split("-")
    return date.fromisoformat(f"{year}-{month:0>2}-{day:0>2}")


@dataclass(frozen=True)
class DateRange:
    """The dates of a run: inclusive ends, and the last date that is consolidated."""

    first: date
    last: date
    limit: date

    def __post_init__(self) -> None:
        if self.first > self.last:
            raise ValueError(f"no dates from {self.first} to {self.last}")

    @classmethod
    def given(cls, first: date, last: date, today: date) -> DateRange:
        """Ends named by the caller; nothing later than today is reported."""
        return cls(first, min(last, today), min(last, today))

    @classmethod
    def back(cls, days: int, today: date, open_day: bool) -> DateRange:
        """So many days before today. An open day is reported but not consolidated."""
        if days < 0:
            raise ValueError("days must not be negative")
        return cls(today - timedelta(days), today, today - timedelta(int(open_day)))

    def dates(self) -> list[date]:
        """Every date up to the limit."""
        stop = min(self.last, self.limit).toordinal()
        return [date.fromordinal(n) for n in range(self.first.toordinal(), stop + 1)]


def resolve_range(
    today: date,
    start: str | date | None = None,
    end: str | date | None = None,
    days: int | None = None,
    look_back: int = DEFAULT_LOOK_BACK,
) -> DateRange:
    """The range that the caller's words ask for: two dates, or days back, or neither."""
    match (start or None, end or None, days):
        case (None, None, None):
            return DateRange.back(look_back, today, open_day=True)
        case (None, None, int(n)):
            return DateRange.back(n, today, open_day=False)
        case (str() | date(), str() | date(), None):
            return DateRange.given(argument_date(start), argument_date(end), today)
    raise ValueError("a range is two dates, or a number of days, or nothing")


def dates_frame(spark: SparkSession, dates: Sequence[date], name: str = "report_date") -> DataFrame:
    """The report dates of a run as a column."""
    return spark.createDataFrame(pa.table({name: pa.array(dates, pa.date32())}))


def date_span(first: Column, last: Column) -> Column:
    """Array of every date from ``first`` to ``last``."""
    return F.sequence(first.cast("date"), last.cast("date"))


def month_edges(dates: DataFrame, day: str = "report_date") -> DataFrame:
    """Each distinct month of ``dates``, spread into the days that open or close a day of it."""
    months = dates.select(F.trunc(day, "MM").alias("_first")).distinct()
    after = F.date_add(F.last_day("_first"), 1)
    edges = months.select("_first", F.explode(date_span(F.col("_first"), after)).alias("_edge"))
    return edges.select(
        F.col("_first").cast("timestamp_ntz").alias("month"),
        F.col("_edge").cast("timestamp_ntz").alias("day"),
    )


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def period_spine(
    dates: DataFrame, shifts: DataFrame, date_column: str = "report_date"
) -> DataFrame:
    """Shift days of every month of ``dates``: ``month``, ``day``, ``start``, ``end``, ``hours``.

    A day starts at the offset effective strictly before it and ends where the next day
    starts; without such an offset the bound is NULL. ``floor`` is how far repairs may look
    back: one month before the start of the month, shifted where an offset is in force.
    Every window here runs over the calendar.
    """
    first_shift = shifts.where(F.col("shift_order") == 1).withColumn("_all", F.lit(1))
    edges = month_edges(dates, date_column).withColumn("_all", F.lit(1))
    edges = latest_effective(
        edges, first_shift, ["_all"], "day", "effective", "start_minutes", out="_open"
    )
    along = Window.partitionBy("month").orderBy("day")
    edges = edges.withColumns(
        {
            "start": plus_minutes(F.col("day"), F.col("_open")),
            "_close": F.lead("_open").over(along),
            "_month_start": F.first("_open").over(along),
        }
    )
    end = plus_minutes(F.col("day") + F.expr("INTERVAL '1' DAY"), F.col("_close"))
    minutes = F.lit(24 * 60) + F.col("_close") - F.col("_open")
    month_start = F.coalesce(plus_minutes(F.col("month"), F.col("_month_start")), F.col("month"))
    return edges.where(F.trunc("day", "MM") == F.to_date("month")).select(
        "month",
        "day",
        "start",
        end.alias("end"),
        (minutes / F.lit(60.0)).alias("hours"),
        (month_start - F.expr("INTERVAL '1' MONTH")).alias("floor"),
    )
