"""Business measures as aggregate columns over the ride fact.

A measure means the same in every context: a filter on the fact, or any group-by.
Ratios of nothing are null, averages skip nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions.calendar import minutes_crossed
from fareline.schemas import BULK_SOURCE, LIVE_SOURCE


def rides(flag: str | None = None) -> Column:
    """Rows, or rows where the boolean column ``flag`` is true."""
    return F.count(F.lit(1)) if flag is None else F.count_if(F.col(flag))


def rides_from(source: str) -> Column:
    return F.count_if(F.col("_source_system") == source)


def mean_where(flag: str, value: str) -> Column:
    return F.avg(F.when(F.col(flag), F.col(value)))


MEASURES: dict[str, Callable[[], Column]] = {
    # volume
    "total_rides": rides,
    "completed_rides": lambda: rides("is_completed"),
    "cancelled_rides": lambda: rides("is_cancelled"),
    "completion_rate": lambda: F.try_divide(rides("is_completed"), rides()),
    "cancellation_rate": lambda: F.try_divide(rides("is_cancelled"), rides()),
    # revenue
    "total_revenue": lambda: F.sum("total_fare"),
    "completed_revenue": lambda: F.sum(F.when(F.col("is_completed"), F.col("total_fare"))),
    "total_tips": lambda: F.sum("tip_amount"),
    "net_subtotal": lambda: F.sum("subtotal"),
    "avg_fare": lambda: F.avg("total_fare"),
    "tip_rate": lambda: F.try_divide(F.sum("tip_amount"), F.sum("subtotal")),
    # surge and distance
    "surged_rides": lambda: rides("is_surged"),
    "surge_share": lambda: F.try_divide(rides("is_surged"), rides()),
    "avg_surge_multiplier": lambda: mean_where("is_surged", "surge_multiplier"),
    "total_miles": lambda: F.sum("distance_miles"),
    "total_hours": lambda: F.sum("duration_minutes") / 60,
    "intercity_share": lambda: F.try_divide(rides("is_intercity"), rides()),
    # ratings
    "rated_rides": lambda: rides("was_rated"),
    "rating_response_rate": lambda: F.try_divide(rides("was_rated"), rides("is_completed")),
    "avg_passenger_rating": lambda: F.avg("passenger_rating_given"),
    # freshness and origin
    "last_ride_received": lambda: F.max("pickup_timestamp"),
    "streaming_rides": lambda: rides_from(LIVE_SOURCE),
    "backfilled_rides": lambda: rides_from(BULK_SOURCE),
}


def minutes_since_last_ride(now: Column) -> Column:
    return minutes_crossed(F.max("pickup_timestamp"), now)


def rides_last_24_hours(now: Column) -> Column:
    return F.count_if(F.col("pickup_timestamp") >= now - F.expr("interval 1 day"))


def measure(
    fact: DataFrame,
    names: Sequence[str] | None = None,
    by: Sequence[str | Column] = (),
    now: Column | None = None,
) -> DataFrame:
    """Evaluate measures per group of ``by``, or once over everything; all if none are named.

    One scan and one partially aggregated shuffle. ``now`` adds the clock measures: the
    minutes since a group's last ride and, over everything, the rides of the last day.
    """
    columns = [MEASURES[name]().alias(name) for name in names or MEASURES]
    if now is not None:
        columns.append(minutes_since_last_ride(now).alias("minutes_since_last_ride"))
        if not by:
            columns.append(rides_last_24_hours(now).alias("rides_last_24_hours"))
    return fact.groupBy(*by).agg(*columns)


def with_rides_last_24_hours(report: DataFrame, fact: DataFrame, now: Column) -> DataFrame:
    """Append the rides of the last day over the *whole* fact, whatever the report's context.

    A report over the whole fact without groups has them already, from its own scan. For
    others the fact is scanned once more, its times only, the bound pushed to the scan.
    """
    recent = fact.where(F.col("pickup_timestamp") >= now - F.expr("interval 1 day"))
    return report.withColumn("rides_last_24_hours", recent.agg(rides()).scalar())


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column, so that results do not depend on summation order.

    Rounding three places further first removes the noise of the sum, so that a tie is
    still seen as one.
    """
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.round(c, places + 3), places) for c in doubles})
