"""Fare and speed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(top: Column, bottom: Column, guard: Column, places: int = 2) -> Column:
    """``top / bottom`` rounded, or null unless ``guard`` is positive."""
    return F.when(guard > 0, F.round(top / bottom, places))


def speed_mph(miles: Column, minutes: Column) -> Column:
    return guarded_ratio(miles, minutes / 60, guard=minutes)


def per_mile(fare: Column, miles: Column) -> Column:
    return guarded_ratio(fare, miles, guard=miles)


def tip_percent(tip: Column, subtotal: Column) -> Column:
    return guarded_ratio(100 * tip, subtotal, guard=subtotal)


def hundredths(amount: Column) -> Column:
    """Money or miles with two decimals as a whole number, free of binary fractions."""
    return F.round(amount * 100).cast("bigint")


def charge(quantity: Column, rate: Column) -> Column:
    """``round(quantity * rate, 2)`` for a rate in whole cents and a quantity in hundredths.

    The product is formed on integers, so a tie rounds up whatever its binary form.
    """
    return F.round(hundredths(quantity) * hundredths(rate) / 10000, 2)


def rate_card_quote(base: Column, mile: Column, minute: Column) -> dict[str, Column]:
    """What the rate card says a ride should have cost, from its miles, minutes, surge and tip."""
    distance_fare = charge(F.col("distance_miles"), mile)
    time_fare = charge(F.col("duration_minutes"), minute)
    subtotal = charge(base + distance_fare + time_fare, F.col("surge_multiplier"))
    return {
        "base_fare": base,
        "distance_fare": distance_fare,
        "time_fare": time_fare,
        "subtotal": subtotal,
        "total_fare": F.round(subtotal + F.col("tip_amount"), 2),
    }
