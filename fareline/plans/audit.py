"""The table tests of silver and gold, and the rate-card audit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.functions.fares import rate_card_quote
from fareline.operators.lookup import lookup
from fareline.operators.quality import TableTests
from fareline.plans.star import DIMENSIONS, ROLES

FARE_BANDS = [*[label for _, label in S.FARE_EDGES], S.FARE_TOP, S.FARE_MISSING]
DISTANCE_BANDS = [*[label for _, label in S.DISTANCE_EDGES], S.DISTANCE_TOP]

SILVER_TESTS = {
    "rides_enriched": TableTests(
        unique=["ride_id"],
        not_null=["ride_id", "pickup_timestamp"],
        expression={"total_fare": "total_fare >= 0"},
    ),
    **{
        name: TableTests(unique=[ref.key], not_null=[ref.key]) for name, ref in S.REFERENCES.items()
    },
}

_keys = {name: TableTests(unique=[d.key], not_null=[d.key]) for name, d in DIMENSIONS.items()}
GOLD_TESTS = {
    **_keys,
    "dim_date": TableTests(unique=["date_key"], not_null=["date_key"]),
    "dim_city": TableTests(unique=["city_key"], not_null=["city_key", "city_name"]),
    "dim_vehicle_type": TableTests(
        unique=["vehicle_type_key"],
        not_null=["vehicle_type_key"],
        accepted_range={"tier_rank": (1, S.TIER_OTHER)},
    ),
    # The status names, the sources and the plausible ranges.
    "dim_ride_status": TableTests(
        unique=["ride_status_key"],
        not_null=["ride_status_key"],
        accepted_values={
            "ride_status_name": ["Completed", "Cancelled", "In-progress", "Unknown"]
        },
    ),
    "fct_rides": TableTests(
        unique=["ride_id"],
        not_null=["ride_id", "date_key", *ROLES, "total_fare"],
        relationships={
            "date_key": ("dim_date", "date_key"),
            **{key: (dim, DIMENSIONS[dim].key) for key, (_, dim) in ROLES.items()},
        },
        accepted_range={
            "total_fare": (0, None),
            "distance_miles": (0, 100),
            "surge_multiplier": (1.0, 3.0),
        },
        accepted_values={
            "fare_band": FARE_BANDS,
            "_source_system": [S.LIVE_SOURCE, S.BULK_SOURCE],
            # Not in the published suite, although every derived category should be tested.
            "distance_band": DISTANCE_BANDS,
        },
    ),
}

FRESH_MINUTES = {"warn_minutes": 30, "error_minutes": 180}


def rate_card_drift(rides: DataFrame, refs: Mapping[str, DataFrame]) -> DataFrame:
    """Each priced ride with what the rate card asks, and how far its charges are off.

    Rides whose vehicle type has no rate card are left out: there is nothing to
    compare with.
    """
    card = {"_base": "base_rate", "_mile": "per_mile", "_minute": "per_minute"}
    priced = lookup(rides, refs["ref_vehicle_types"], "vehicle_type_id", "vehicle_type_id", **card)
    quote = rate_card_quote(F.col("_base"), F.col("_mile"), F.col("_minute"))
    # Both sides are whole cents: rounding removes only the binary noise of the difference.
    drift = {f"{name}_drift": F.round(F.col(name) - asked, 2) for name, asked in quote.items()}
    return priced.where(F.col("_base").isNotNull()).withColumns(drift).drop(*card)


def rate_card_audit(rides: DataFrame, refs: Mapping[str, DataFrame], tolerance: float = 0.05) -> DataFrame:
    """Rides and charges off the rate card per vehicle type."""
    drift = rate_card_drift(rides, refs)
    off = F.abs("subtotal_drift") >= tolerance
    return drift.groupBy("vehicle_type_id").agg(
        F.count(F.lit(1)).alias("rides"),
        F.count_if(off).alias("rides_off"),
        F.sum("subtotal_drift").alias("subtotal_drift"),
        F.max(F.abs("total_fare_drift")).alias("largest_total_drift"),
        *[
            F.count_if(F.col(f"{part}_drift") != 0).alias(f"{part}_off")
            for part in ("base_fare", "distance_fare", "time_fare")
        ],
    )
