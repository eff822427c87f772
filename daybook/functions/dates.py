"""Run dates and durations."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

RunDate = Column | date | str


def parse_run_date(value: date | str) -> date:
    """A ``YYYY-MM-DD`` argument as a date; anything else is an error."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    try:
        return datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError as error:
        raise ValueError(f"Run date {value!r} is not a YYYY-MM-DD date.") from error


def parse_run_dates(values: list[date | str] | date | str) -> list[date]:
    """One run date or many, in order and each once."""
    many = values if isinstance(values, (list, tuple, set)) else [values]
    return sorted({parse_run_date(v) for v in many})


def resolve_run_date(configured: str | None, logical_date: date) -> date:
    """The configured run date where one is given, else the logical date."""
    return parse_run_date(configured or logical_date)


def run_date_column(run_date: RunDate) -> Column:
    """A run date as a column: a literal day, or the feed's own date column."""
    if isinstance(run_date, Column):
        return run_date
    return F.lit(parse_run_date(run_date))


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with microsecond precision."""

    def micros(instant: Column) -> Column:
        return F.unix_micros(instant.cast("timestamp"))

    return (micros(end) - micros(start)) / F.lit(1e6)
