"""Time intelligence: what a measure is worth on each date of the calendar.

The fact is aggregated to days first. Days and calendar dates are then put in blocks of
bounded length, months or runs of days, and a window over each group's block adds up the
days that a date must see. A day that dates of the next block must see is copied there.
So dates without rides get their value too, and a window holds some dozens of rows, however
large a group is.

Days are added up, so an amount must be additive: a sum or a count. A ratio is given as
its additive parts and an expression over their names, which is evaluated last. Rides off
the calendar, or without a date, have no row here as no date shows them; measures without
a calendar count them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Days of a block of a rolling total, if the total doesn't span more.
LEAST_BLOCK = 32

Amount = Column | tuple[Mapping[str, Column], Column]

_NOT_ADDITIVE = re.compile(r"\b(avg|mean|min|max|median|mode|percentile\w*|std\w*|var\w*|approx\w*)\(|distinct", re.I)


def additive(amount: Amount) -> tuple[dict[str, Column], Column]:
    """The parts that are added up over days, and what is made of their sums."""
    parts, final = ({"amount": amount}, F.col("amount")) if isinstance(amount, Column) else amount
    for name, part in parts.items():
        if _NOT_ADDITIVE.search(str(part)):
            raise ValueError(f"{name} can't be added up over days: {part}; give its additive parts")
    return dict(parts), final


def daily(
    fact: DataFrame, parts: Mapping[str, Column], by: Sequence[str] = (), day: str = "date_key"
) -> DataFrame:
    """One row per group and day that has rides."""
    dated = fact.where(F.col(day).isNotNull())
    return dated.groupBy(*by, F.col(day).alias("day")).agg(*[c.alias(name) for name, c in parts.items()])


def _add_up(
    days: DataFrame, dates: DataFrame, frame: tuple[int, int], parts: Sequence[str], final: Column, by: Sequence[str], name: str
) -> DataFrame:
    """Each date of a group's blocks with the parts of the days in its frame.

    days: _block, day and parts by group; dates: _block and date_key of the calendar. The
    frame counts days from the date. A date that sees no day has no row.
    """
    kinds = dict(days.dtypes)
    shown = days.select(*by, "_block").distinct().join(dates, "_block").select(
        *by, "_block", "date_key", F.col("date_key").alias("day"), *[F.lit(None).cast(kinds[p]).alias(p) for p in parts]
    )
    both = days.withColumn("date_key", F.lit(None).cast("date")).unionByName(shown)
    window = Window.partitionBy(*by, "_block").orderBy(F.unix_date("day")).rangeBetween(*frame)
    seen = F.count_if(F.col("date_key").isNull()).over(window).alias("_days")
    summed = both.select(*by, "date_key", seen, *[F.sum(p).over(window).alias(p) for p in parts])
    return summed.where("date_key is not null and _days > 0").select(*by, "date_key", final.alias(name))


def month_to_date(
    fact: DataFrame, calendar: DataFrame, amount: Amount, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Running total from the first of the month through each calendar date."""
    parts, final = additive(amount)
    days = on_calendar(daily(fact, parts, by), calendar).withColumn("_block", F.trunc("day", "month"))
    dates = calendar.select("date_key", F.trunc("date_key", "month").alias("_block"))
    return _add_up(days, dates, (Window.unboundedPreceding, 0), list(parts), final, by, name)


def rolling_days(
    fact: DataFrame, calendar: DataFrame, amount: Amount, days: int, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Total of the last ``days`` days, the date itself included."""
    size = max(days, LEAST_BLOCK)
    parts, final = additive(amount)
    listed = on_calendar(daily(fact, parts, by), calendar)
    number = F.unix_date("day")
    own = listed.withColumn("_block", F.floor(number / size))
    # The last days of a block are seen by the first dates of the next one.
    late = listed.where(F.pmod(number, F.lit(size)) > size - days).withColumn("_block", F.floor(number / size) + 1)
    dates = calendar.select("date_key", F.floor(F.unix_date("date_key") / size).alias("_block"))
    return _add_up(own.unionByName(late), dates, (1 - days, 0), list(parts), final, by, name)


def on_calendar(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Keep the days that the calendar knows."""
    return days.join(calendar.select(F.col("date_key").alias("day")), "day", "left_semi")


def month_over_month(
    fact: DataFrame, calendar: DataFrame, amount: Amount, by: Sequence[str] = ()
) -> DataFrame:
    """Current and prior month per calendar month, and the relative change.

    A month appears if it or the month before has rides. The change is null where
    there is no prior month, and -1 where a month without rides follows one with.
    """
    parts, final = additive(amount)
    first = F.trunc("day", "month")
    sums = on_calendar(daily(fact, parts, by), calendar).groupBy(
        *by, first.alias("first_day_of_month")
    ).agg(*[F.sum(part).alias(part) for part in parts])
    months = sums.select(*by, "first_day_of_month", final.alias("amount"))
    ahead = F.add_months("first_day_of_month", 1).alias("first_day_of_month")
    # Two credits of one amount: to its own month, and as prior of the next.
    both = months.select(*by, "first_day_of_month", F.col("amount").alias("current")).unionByName(
        months.select(*by, ahead, F.col("amount").alias("prior")), allowMissingColumns=True
    )
    paired = both.groupBy(*by, "first_day_of_month").agg(
        F.sum("current").alias("current"), F.sum("prior").alias("prior")
    )
    known = calendar.select("first_day_of_month").distinct()
    change = F.try_divide(F.coalesce("current", F.lit(0)) - F.col("prior"), F.col("prior"))
    return paired.join(known, "first_day_of_month", "left_semi").withColumn("change", change)


def same_day_prior_month(
    fact: DataFrame, calendar: DataFrame, amount: Amount, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Amount of the same day one month earlier, or of that month's last day if it is shorter."""
    looks_at = calendar.select("date_key", F.add_months("date_key", -1).alias("day"))
    parts, final = additive(amount)
    listed = on_calendar(daily(fact, parts, by), calendar)
    return listed.join(looks_at, "day").select(*by, "date_key", final.alias(name))
