"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def year_month(day: Column) -> Column:
    """202603 for any day of March 2026: an integer that sorts by time."""
    return F.year(day) * 100 + F.month(day)


def year_quarter(day: Column) -> Column:
    return F.year(day) * 10 + F.quarter(day)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two instants: 10:00:59 to 10:01:00 is one."""
    seconds = F.unix_timestamp(F.date_trunc("minute", end)) - F.unix_timestamp(
        F.date_trunc("minute", start)
    )
    return (seconds / 60).cast("bigint")


def calendar_columns(day: Column, today: Column) -> list[Column]:
    """The 21 attributes of a date-dimension row."""

    def text(pattern: str) -> Column:
        return F.date_format(day, pattern)

    attributes = {
        "date_key": day,
        "calendar_date": day,
        "calendar_year": F.year(day),
        "calendar_quarter": F.quarter(day),
        "calendar_month": F.month(day),
        "day_of_month": F.day(day),
        "day_of_week_number": F.dayofweek(day),
        "week_of_year": F.weekofyear(day),
        "month_name": text("MMMM"),
        "month_name_short": text("MMM"),
        "day_name": text("EEEE"),
        "day_name_short": text("EEE"),
        "quarter_label": F.format_string("Q%d %d", F.quarter(day), F.year(day)),
        "month_label": text("MMM yyyy"),
        "year_month_number": year_month(day),
        "year_quarter_number": year_quarter(day),
        "first_day_of_month": F.trunc(day, "month"),
        "last_day_of_month": F.last_day(day),
        "is_weekend": is_weekend(day),
        "is_today": day == today,
        "is_past": day <= today,
    }
    return [column.alias(name) for name, column in attributes.items()]
