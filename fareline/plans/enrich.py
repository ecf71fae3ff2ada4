"""Silver rides_enriched: every ride with its reference attributes and derived columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.functions import bands, calendar, fares
from fareline.operators.expectations import enforce
from fareline.operators.lookup import lookup

# Ride column -> reference table, and the attributes taken from it (new name -> column).
ATTRIBUTES = {
    "pickup_city_id": (
        "ref_cities",
        {"pickup_city": "city", "pickup_state": "state", "pickup_region": "region"},
    ),
    "dropoff_city_id": (
        "ref_cities",
        {"dropoff_city": "city", "dropoff_state": "state", "dropoff_region": "region"},
    ),
    "vehicle_type_id": (
        "ref_vehicle_types",
        {
            "vehicle_type": "vehicle_type",
            "vehicle_type_description": "description",
            "base_rate": "base_rate",
            "per_mile": "per_mile",
            "per_minute": "per_minute",
        },
    ),
    "vehicle_make_id": ("ref_vehicle_makes", {"vehicle_make": "vehicle_make"}),
    "payment_method_id": (
        "ref_payment_methods",
        {
            "payment_method": "payment_method",
            "is_card": "is_card",
            "requires_auth": "requires_auth",
        },
    ),
    "ride_status_id": (
        "ref_ride_statuses",
        {"ride_status": "ride_status", "is_completed": "is_completed"},
    ),
    "cancellation_reason_id": (
        "ref_cancellation_reasons",
        {"cancellation_reason": "cancellation_reason"},
    ),
}


def described(rides: DataFrame, refs: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins only: a ride without a reference row keeps null attributes."""
    for on, (table, columns) in ATTRIBUTES.items():
        rides = lookup(rides, refs[table], on, S.REFERENCES[table].key, **columns)
    return rides


def derived() -> dict[str, Column]:
    """The columns computed from the ride itself."""
    pickup = F.col("pickup_timestamp")
    miles, minutes = F.col("distance_miles"), F.col("duration_minutes")
    return {
        "ride_date": F.to_date(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_day_of_week": F.date_format(pickup, "EEEE"),
        "is_weekend": calendar.is_weekend(pickup),
        "duration_hours": F.round(minutes / 60, 3),
        "avg_speed_mph": fares.speed_mph(miles, minutes),
        "fare_per_mile": fares.per_mile(F.col("total_fare"), miles),
        "tip_percentage": fares.tip_percent(F.col("tip_amount"), F.col("subtotal")),
        "is_surged": F.col("surge_multiplier") > 1.0,
        "is_intercity": F.col("pickup_city_id") != F.col("dropoff_city_id"),
        "distance_band": bands.distance_band(miles),
    }


def enriched(
    rides: DataFrame, refs: Mapping[str, DataFrame], processed_at: Column | None = None
) -> DataFrame:
    """Silver rides joined to the reference tables, before any constraint."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return described(rides, refs).withColumns({**derived(), "_silver_processed_at": stamp})


def rides_enriched(
    rides: DataFrame,
    refs: Mapping[str, DataFrame],
    processed_at: Column | None = None,
    metrics: str | Observation | None = None,
) -> DataFrame:
    """The enriched rides that meet the constraints."""
    return enforce(enriched(rides, refs, processed_at), S.ENRICHED_RULES, metrics)
