"""Fixed values of the ride data model: names, types, keys and constraint texts.

Everything here is plain data that the results depend on. Types are Spark DDL,
so nothing in this module needs a running session.
"""

from __future__ import annotations

from dataclasses import dataclass

# The ride event, field by field, in the producer's order.
RIDE_DDL = """
ride_id string, confirmation_number string,
passenger_id string, driver_id string, vehicle_id string,
vehicle_type_id int, vehicle_make_id int, payment_method_id int, ride_status_id int,
pickup_city_id int, dropoff_city_id int, cancellation_reason_id int,
passenger_name string, passenger_email string, passenger_phone string,
driver_name string, driver_rating double, driver_phone string, driver_license string,
vehicle_model string, vehicle_color string, license_plate string,
pickup_address string, pickup_latitude double, pickup_longitude double,
dropoff_address string, dropoff_latitude double, dropoff_longitude double,
distance_miles double, duration_minutes int,
booking_timestamp string, pickup_timestamp string, dropoff_timestamp string,
base_fare double, distance_fare double, time_fare double, surge_multiplier double,
subtotal double, tip_amount double, total_fare double, rating int
""".replace("\n", " ").strip()


def ddl_fields(ddl: str) -> dict[str, str]:
    """Name -> type of a flat DDL text, in order."""
    return dict(field.split() for field in ddl.split(","))


RIDE_TYPES = ddl_fields(RIDE_DDL)
RIDE_FIELDS = list(RIDE_TYPES)
# The event carries these as ISO-8601 text; silver holds them as timestamps.
RIDE_TIMES = ("booking_timestamp", "pickup_timestamp", "dropoff_timestamp")

SILVER_RIDE_TYPES = {
    **{name: "timestamp" if name in RIDE_TIMES else kind for name, kind in RIDE_TYPES.items()},
    "_source_system": "string",
    "_ingested_at": "timestamp",
}
SILVER_RIDE_DDL = ", ".join(f"{name} {kind}" for name, kind in SILVER_RIDE_TYPES.items())

BRONZE_RIDE_DDL = (
    "kafka_key string, ride_payload string, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_enqueued_at timestamp, _ingested_at timestamp, _batch_id string"
)
KAFKA_RECORD_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

LIVE_SOURCE = "eventhub"
BULK_SOURCE = "bulk_file"

UNKNOWN_KEY = -1
SPINE_START = "2020-01-01"
SPINE_END = "2028-01-01"  # exclusive

DEDUP_HORIZON = "10 minutes"
LOOK_BACK = "1 hour"


@dataclass(frozen=True)
class Reference:
    """A reference table: where its files land, its key, and its typed columns."""

    source: str
    key: str
    ddl: str

    @property
    def types(self) -> dict[str, str]:
        return ddl_fields(self.ddl)


# The six reference tables.
REFERENCES = {
    "ref_cities": Reference(
        "map_cities", "city_id", "city_id int, city string, state string, region string"
    ),
    "ref_vehicle_types": Reference(
        "map_vehicle_types",
        "vehicle_type_id",
        "vehicle_type_id int, vehicle_type string, description string, "
        "base_rate double, per_mile double, per_minute double",
    ),
    "ref_vehicle_makes": Reference(
        "map_vehicle_makes", "vehicle_make_id", "vehicle_make_id int, vehicle_make string"
    ),
    "ref_payment_methods": Reference(
        "map_payment_methods",
        "payment_method_id",
        "payment_method_id int, payment_method string, is_card boolean, requires_auth boolean",
    ),
    "ref_ride_statuses": Reference(
        "map_ride_statuses",
        "ride_status_id",
        "ride_status_id int, ride_status string, is_completed boolean",
    ),
    "ref_cancellation_reasons": Reference(
        "map_cancellation_reasons",
        "cancellation_reason_id",
        "cancellation_reason_id int, cancellation_reason string",
    ),
}

# Folders read incrementally as JSON files.
FILE_TABLES = ["bulk_rides", *(ref.source for ref in REFERENCES.values())]


@dataclass(frozen=True)
class Rule:
    """A row constraint and what happens to rows that break it: warn, drop or fail."""

    name: str
    condition: str
    action: str


# Constraint names, conditions and actions per table.
RAW_RULES = (Rule("value_not_null", "ride_payload IS NOT NULL", "fail"),)
STAGING_RULES = (
    Rule("valid_ride_id", "ride_id IS NOT NULL", "drop"),
    Rule("valid_booking_time", "booking_timestamp IS NOT NULL", "drop"),
    Rule("plausible_surge", "surge_multiplier BETWEEN 1.0 AND 3.0", "warn"),
    Rule("plausible_rating", "rating IS NULL OR rating BETWEEN 1 AND 5", "warn"),
    Rule("non_negative_fare", "total_fare >= 0", "warn"),
)
ENRICHED_RULES = (
    Rule("valid_ride_id", "ride_id IS NOT NULL", "drop"),
    Rule("positive_distance", "distance_miles > 0", "drop"),
    Rule("non_negative_total", "total_fare >= 0", "drop"),
    Rule(
        "coherent_timestamps",
        "dropoff_timestamp IS NULL OR dropoff_timestamp >= pickup_timestamp",
        "drop",
    ),
    Rule(
        "fare_reconciles",
        "abs(subtotal - round((base_fare + distance_fare + time_fare) * surge_multiplier, 2))"
        " < 0.05",
        "warn",
    ),
    Rule(
        "cancelled_has_reason",
        "ride_status_id = 1 OR cancellation_reason_id BETWEEN 1 AND 3",
        "warn",
    ),
    Rule("pickup_in_range", "pickup_latitude BETWEEN -90 AND 90", "warn"),
)


def reference_rules(key: str) -> tuple[Rule, ...]:
    return (
        Rule("key_not_null", f"{key} IS NOT NULL", "fail"),
        Rule("key_is_unique", "_key_occurrences = 1", "fail"),
    )


# Category texts and their upper edges.
DISTANCE_EDGES = ((3, "Short"), (10, "Medium"), (25, "Long"))
DISTANCE_TOP = "Very long"
FARE_EDGES = ((15, "Under $15"), (30, "$15 to $30"), (60, "$30 to $60"), (120, "$60 to $120"))
FARE_TOP = "$120 and over"
FARE_MISSING = "Unknown"

# Service tiers from cheapest to dearest.
TIERS = ("UberPOOL", "UberX", "Uber Comfort", "UberXL", "Uber Black")
TIER_OTHER = 99

NOT_CANCELLED_REASON = 4
