"""Calendar columns, month arithmetic and half-open date windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_date(ts: Column) -> Column:
    return F.to_date(ts)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 on the clock a zoneless timestamp shows, in any session time zone."""
    seconds = (F.unix_date(F.to_date(ts)).cast("long") * 24 + F.hour(ts)) * 3600 + F.minute(ts) * 60
    return seconds * 1000000 + (F.date_part(F.lit("SECOND"), ts) * 1000000).cast("long")


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def inside_month(ts: Column, year: Column, month: Column) -> Column:
    """True when ``ts`` lies in the half-open month the source file is named after."""
    first = month_start(year, month)
    return (ts >= first.cast("timestamp_ntz")) & (ts < F.add_months(first, 1).cast("timestamp_ntz"))


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def day_name(day: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(day, "EEEE")


def day_of_week(day: Column) -> Column:
    """Weekday number with Sunday = 0."""
    return F.dayofweek(day) - 1


def month_index(day: Column) -> Column:
    """Months since year 0, so that a difference is a number of calendar months."""
    return F.year(day) * 12 + F.month(day) - 1


def month_start_with_lag(day: Column, lag: int) -> Column:
    if lag < 0:
        raise ValueError("lag must not be negative")
    return F.add_months(F.trunc(day, "month"), -lag)


def in_months(months: list[tuple[int, int]], year: str = "source_year", month: str = "source_month") -> Column:
    """True for the given (year, month) pairs; on directory columns this prunes directories."""
    return (F.col(year) * 12 + F.col(month)).isin([y * 12 + m for y, m in months])


def previous_month_starts(day: Column, count: int) -> Column:
    """Array with the starts of the previous ``count`` months, oldest first."""
    if count <= 0:
        raise ValueError("count must be positive")
    first = F.trunc(day, "month")
    return F.sequence(F.add_months(first, -count), F.add_months(first, -1), F.expr("interval 1 month"))


@dataclass(frozen=True)
class DateWindow:
    """A half-open range of days."""

    start: date
    end: date

    @staticmethod
    def year(year: int) -> DateWindow:
        return DateWindow(date(year, 1, 1), date(year + 1, 1, 1))

    @staticmethod
    def first_half(year: int) -> DateWindow:
        return DateWindow(date(year, 1, 1), date(year, 7, 1))

    @staticmethod
    def month(year: int, month: int) -> DateWindow:
        end = date(year, month + 1, 1) if month < 12 else date(year + 1, 1, 1)
        return DateWindow(date(year, month, 1), end)

    def days(self, col: str = "pickup_date") -> Column:
        return (F.col(col) >= F.lit(self.start)) & (F.col(col) < F.lit(self.end))

    def partitions(self, year: str = "source_year", month: str = "source_month") -> Column:
        """The source months that can hold these days.

        Rows are kept only inside their source month, so a day range implies a month range. Spark
        cannot infer that, and without it a window query lists every month of the table.
        """
        index = F.col(year) * 12 + F.col(month)
        last = self.end.year * 12 + self.end.month - (1 if self.end.day == 1 else 0)
        return index.between(self.start.year * 12 + self.start.month, last)

    def over(self, df):
        """Keep the window's rows, with the implied partition filter where the table has one."""
        kept = df.where(self.days())
        if {"source_year", "source_month"} <= set(df.columns):
            kept = kept.where(self.partitions())
        return kept


def between_days(df, first: date, last: date, col: str = "pickup_date"):
    """Inclusive range, as BI tools ask for it."""
    kept = df.where(F.col(col).between(F.lit(first), F.lit(last)))
    if {"source_year", "source_month"} <= set(df.columns):
        index = F.col("source_year") * 12 + F.col("source_month")
        kept = kept.where(index.between(first.year * 12 + first.month, last.year * 12 + last.month))
    return kept
