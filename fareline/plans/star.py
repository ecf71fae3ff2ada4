"""Gold: staging renames, dimensions with their unknown member, and the ride fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.functions.bands import fare_band, tier_rank
from fareline.functions.calendar import calendar_columns
from fareline.operators.lookup import lookup

# Gold name -> silver name, per reference table. Order is the column order.
STAGED = {
    "ref_cities": {
        "city_id": "city_id",
        "city_name": "city",
        "state_code": "state",
        "region_name": "region",
    },
    "ref_vehicle_types": {
        "vehicle_type_id": "vehicle_type_id",
        "vehicle_type_name": "vehicle_type",
        "vehicle_type_description": "description",
        "base_rate": "base_rate",
        "rate_per_mile": "per_mile",
        "rate_per_minute": "per_minute",
    },
    "ref_vehicle_makes": {
        "vehicle_make_id": "vehicle_make_id",
        "vehicle_make_name": "vehicle_make",
    },
    "ref_payment_methods": {
        "payment_method_id": "payment_method_id",
        "payment_method_name": "payment_method",
        "is_card": "is_card",
        "requires_auth": "requires_auth",
    },
    "ref_ride_statuses": {
        "ride_status_id": "ride_status_id",
        "ride_status_name": "ride_status",
        "is_completed": "is_completed",
    },
    "ref_cancellation_reasons": {
        "cancellation_reason_id": "cancellation_reason_id",
        "cancellation_reason_name": "cancellation_reason",
    },
}

# What gold takes from the enriched rides. No names, contacts, addresses or plates.
STAGED_RIDE = (
    "ride_id",
    "confirmation_number",
    "passenger_id",
    "driver_id",
    "vehicle_id",
    "vehicle_type_id",
    "vehicle_make_id",
    "payment_method_id",
    "ride_status_id",
    "pickup_city_id",
    "dropoff_city_id",
    "cancellation_reason_id",
    "booking_timestamp",
    "pickup_timestamp",
    "dropoff_timestamp",
    "ride_date",
    "pickup_hour",
    "pickup_day_of_week",
    "is_weekend",
    "distance_miles",
    "duration_minutes",
    "duration_hours",
    "avg_speed_mph",
    "distance_band",
    "is_intercity",
    "base_fare",
    "distance_fare",
    "time_fare",
    "surge_multiplier",
    "is_surged",
    "subtotal",
    "tip_amount",
    "total_fare",
    "fare_per_mile",
    "tip_percentage",
    "rating",
    "driver_rating",
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
    "_source_system",
    "_silver_processed_at",
)
STAGED_RIDE_NAMES = {"rating": "passenger_rating_given", "driver_rating": "driver_lifetime_rating"}


def stage_reference(name: str, ref: DataFrame) -> DataFrame:
    staged = ref.select(*[F.col(old).alias(new) for new, old in STAGED[name].items()])
    if name == "ref_cancellation_reasons":
        not_cancelled = F.col("cancellation_reason_id") == S.NOT_CANCELLED_REASON
        staged = staged.withColumn("is_not_cancelled", not_cancelled)
    return staged


def stage_rides(enriched: DataFrame) -> DataFrame:
    return enriched.select(*STAGED_RIDE).withColumnsRenamed(STAGED_RIDE_NAMES)


@dataclass(frozen=True)
class Dimension:
    """A dimension over one reference table, keyed by its natural id.

    ``unknown`` holds the unknown member's attributes; those not listed are null.
    """

    ref: str
    subject: str
    unknown: Mapping[str, object]
    extra: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return f"{self.subject}_key"

    @property
    def id(self) -> str:
        return f"{self.subject}_id"


# The unknown member of each dimension.
DIMENSIONS = {
    "dim_city": Dimension(
        "ref_cities",
        "city",
        {"city_name": "Unknown", "state_code": "Unknown", "region_name": "Unknown"},
    ),
    "dim_vehicle_type": Dimension(
        "ref_vehicle_types",
        "vehicle_type",
        {
            "vehicle_type_name": "Unknown",
            "vehicle_type_description": "Unknown",
            "tier_rank": S.TIER_OTHER,
        },
        {"tier_rank": lambda: tier_rank(F.col("vehicle_type_name"))},
    ),
    "dim_vehicle_make": Dimension(
        "ref_vehicle_makes", "vehicle_make", {"vehicle_make_name": "Unknown"}
    ),
    "dim_payment_method": Dimension(
        "ref_payment_methods", "payment_method", {"payment_method_name": "Unknown"}
    ),
    "dim_ride_status": Dimension(
        "ref_ride_statuses", "ride_status", {"ride_status_name": "Unknown"}
    ),
    "dim_cancellation_reason": Dimension(
        "ref_cancellation_reasons",
        "cancellation_reason",
        {
            "cancellation_reason_name": "Unknown",
            "is_not_cancelled": False,
            "is_actual_cancellation": False,
        },
        {"is_actual_cancellation": lambda: ~F.col("is_not_cancelled")},
    ),
}


def dimension(name: str, ref: DataFrame) -> DataFrame:
    """The reference rows keyed by their id, and one row for facts without a match."""
    dim = DIMENSIONS[name]
    staged = stage_reference(dim.ref, ref)
    known = staged.select(
        F.col(dim.id).alias(dim.key),
        "*",
        *[make().alias(column) for column, make in dim.extra.items()],
        F.lit(False).alias("is_unknown_member"),
    )
    values = {
        dim.key: S.UNKNOWN_KEY, dim.id: S.UNKNOWN_KEY, **dim.unknown, "is_unknown_member": True
    }
    # A literal row of a known size, so the dimension's size estimate stays exact.
    unknown = ref.sparkSession.sql("SELECT 1").select(
        *[F.lit(values.get(column)).cast(kind).alias(column) for column, kind in known.dtypes]
    )
    return known.unionByName(unknown)


def dim_date(
    spark: SparkSession,
    today: Column | None = None,
    start: str = S.SPINE_START,
    end: str = S.SPINE_END,
) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    first, last = F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1)
    days = spark.sql("SELECT 1").select(F.explode(F.sequence(first, last)).alias("day"))
    return days.select(*calendar_columns(F.col("day"), F.current_date() if today is None else today))


def dimensions(refs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: dimension(name, refs[dim.ref]) for name, dim in DIMENSIONS.items()}


# Fact key -> the ride column and the dimension it is found by. The city plays two roles.
ROLES = {
    "pickup_city_key": ("pickup_city_id", "dim_city"),
    "dropoff_city_key": ("dropoff_city_id", "dim_city"),
    "vehicle_type_key": ("vehicle_type_id", "dim_vehicle_type"),
    "vehicle_make_key": ("vehicle_make_id", "dim_vehicle_make"),
    "payment_method_key": ("payment_method_id", "dim_payment_method"),
    "ride_status_key": ("ride_status_id", "dim_ride_status"),
    "cancellation_reason_key": ("cancellation_reason_id", "dim_cancellation_reason"),
}
# Flags that come with a dimension row, false where there is none.
FLAGS = {
    "ride_status_key": {"is_completed": "is_completed"},
    "cancellation_reason_key": {"is_cancelled": "is_actual_cancellation"},
}

# The fact's columns in order. Those not computed come from the ride.
FACT_COLUMNS = (
    "ride_id",
    "confirmation_number",
    "date_key",
    "pickup_city_key",
    "dropoff_city_key",
    "vehicle_type_key",
    "vehicle_make_key",
    "payment_method_key",
    "ride_status_key",
    "cancellation_reason_key",
    "passenger_id",
    "driver_id",
    "vehicle_id",
    "booking_timestamp",
    "pickup_timestamp",
    "dropoff_timestamp",
    "pickup_hour",
    "pickup_day_of_week",
    "is_weekend",
    "distance_miles",
    "duration_minutes",
    "base_fare",
    "distance_fare",
    "time_fare",
    "subtotal",
    "tip_amount",
    "total_fare",
    "ride_count",
    "surge_multiplier",
    "avg_speed_mph",
    "fare_per_mile",
    "tip_percentage",
    "passenger_rating_given",
    "driver_lifetime_rating",
    "was_rated",
    "is_surged",
    "is_intercity",
    "distance_band",
    "fare_band",
    "is_completed",
    "is_cancelled",
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
    "_source_system",
    "_silver_processed_at",
    "_gold_built_at",
)


def fct_rides(
    rides: DataFrame, dims: Mapping[str, DataFrame], built_at: Column | None = None
) -> DataFrame:
    """The fact from staged rides. A ride without a dimension row gets the unknown key."""
    computed = {
        "date_key": F.col("ride_date").cast("date"),
        "ride_count": F.lit(1),
        "fare_per_mile": F.try_divide("total_fare", "distance_miles"),
        "tip_percentage": F.try_divide(F.col("tip_amount") * 100, F.col("subtotal")),
        "was_rated": F.col("passenger_rating_given").isNotNull(),
        "fare_band": fare_band(F.col("total_fare")),
        "_gold_built_at": F.current_timestamp() if built_at is None else built_at,
    }
    for fact_key, (on, dim_name) in ROLES.items():
        dim, flags = DIMENSIONS[dim_name], FLAGS.get(fact_key, {})
        rides = lookup(rides, dims[dim_name], on, dim.id, **{fact_key: dim.key}, **flags)
        computed[fact_key] = F.coalesce(fact_key, F.lit(S.UNKNOWN_KEY))
        computed |= {flag: F.coalesce(flag, F.lit(False)) for flag in flags}
    return rides.select(
        *[computed[c].alias(c) if c in computed else c for c in FACT_COLUMNS]
    )
