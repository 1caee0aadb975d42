"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(ts: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", ts))


def week_end(ts: Column) -> Column:
    """Sunday of the week."""
    return F.date_add(week_start(ts), 6)


def day(ts: Column) -> Column:
    return F.to_date(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_holiday_season(ts: Column) -> Column:
    return F.month(ts).isin(11, 12, 1).cast("int")


def days_since_2020(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit("2020-01-01").cast("date"))
