import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.plans import audit
from fareline.plans.enrich import enriched, rides_enriched
from fareline.plans.staging import bulk_rides, live_rides, parsed, staged, thin_repeats, typed
from fareline.plans.star import dimensions, fct_rides, stage_rides
from fareline.sources.kafka import bronze_rides, read_topic
from fareline.workload.rides import references

EVENT = {
    "ride_id": "r1", "vehicle_type_id": 1, "vehicle_make_id": 1, "payment_method_id": 1, "ride_status_id": 1,
    "pickup_city_id": 1, "dropoff_city_id": 2, "cancellation_reason_id": 4, "pickup_latitude": 40.7,
    "distance_miles": 10.0, "duration_minutes": 30, "booking_timestamp": "2026-03-07T09:55:00",
    "pickup_timestamp": "2026-03-07T10:00:00", "dropoff_timestamp": "2026-03-07T10:30:00",
    "base_fare": 2.5, "distance_fare": 17.5, "time_fare": 10.5, "surge_multiplier": 1.0,
    "subtotal": 30.5, "tip_amount": 3.05, "total_fare": 33.55, "rating": 5,
}


def records(spark, *payloads, times=None):
    times = times or [datetime(2026, 3, 7, 10)] * len(payloads)
    data = [(b"k", None if p is None else p.encode(), "rides", 0, i, t) for i, (p, t) in enumerate(zip(payloads, times))]
    return spark.createDataFrame(data, S.KAFKA_RECORD_DDL)


def live(spark, *events):
    return typed(parsed(bronze_rides(records(spark, *[json.dumps({**EVENT, **e}) for e in events]))), S.LIVE_SOURCE)


def test_schema_has_the_declared_fields():
    assert len(S.RIDE_FIELDS) == 41 and len(S.SILVER_RIDE_TYPES) == 43


def test_bronze_envelope(spark):
    bronze = bronze_rides(records(spark, "{}"))
    assert bronze.columns == [f.split()[0] for f in S.BRONZE_RIDE_DDL.split(", ")]
    assert bronze.first().ride_payload == "{}"


def test_kafka_source_needs_its_connector(spark):
    """The connector is no part of this build: the reader must get as far as asking for it."""
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "broker:9093", "rides", {"kafka.security.protocol": "SASL_SSL"})


def test_parsing_is_permissive(spark):
    mistyped = json.dumps({**EVENT, "rating": "five"})
    rides = parsed(bronze_rides(records(spark, "{bad", mistyped, "[]")))
    assert [(r.ride_id, r.rating, r.total_fare) for r in rides.collect()] == [
        (None, None, None), ("r1", None, 33.55), (None, None, None),
    ]


def test_timestamps_agree_with_and_without_offset(spark):
    rides = live(spark, {}, {"booking_timestamp": "2026-03-07T11:55:00+02:00"}, {"booking_timestamp": "soon"})
    assert [r.booking_timestamp for r in rides.collect()] == [datetime(2026, 3, 7, 9, 55)] * 2 + [None]
    # Text that is no time is dropped by its rule instead of stopping the job.
    assert staged(rides).count() == 2


def test_bulk_rides_take_the_declared_types(spark):
    """File inference makes integers long and may never see a field."""
    bronze = spark.createDataFrame([("b1", 3, "2026-03-07T09:55:00+00:00", datetime(2026, 3, 8))],
                                   "ride_id string, vehicle_type_id bigint, booking_timestamp string, _ingested_at timestamp")
    rides = bulk_rides(bronze)
    assert rides.dtypes == list(S.SILVER_RIDE_TYPES.items())
    row = rides.first()
    assert (row.vehicle_type_id, row.rating, row._source_system) == (3, None, "bulk_file")


def test_batch_dedup_keeps_the_first_arrival(spark):
    first, again, nameless = [json.dumps({**EVENT, **e}) for e in ({"rating": 3}, {"rating": 4}, {"ride_id": None})]
    times = [datetime(2026, 3, 7, 10, m) for m in (5, 0, 1, 2)]
    rides = live_rides(bronze_rides(records(spark, again, first, nameless, nameless, times=times)))
    assert [(r.ride_id, r.rating) for r in rides.collect()] == [("r1", 3)]


def test_thinning_keeps_one_row_per_key_and_all_without(spark, rows):
    df = rows([("a", 1)] * 50 + [("b", 2), (None, 3), (None, 4)], "ride_id string, v int").coalesce(1)
    assert sorted(map(tuple, thin_repeats(df).collect()), key=str) == [("a", 1), ("b", 2), (None, 3), (None, 4)]


def test_derived_columns(spark):
    refs = references(spark)
    row = enriched(live(spark, {"tip_amount": 3.0, "total_fare": 33.6}), refs).first()
    assert (row.pickup_city, row.dropoff_state, row.vehicle_type, row.payment_method) == ("New York", "CA", "UberX", "Credit Card")
    assert (row.pickup_hour, row.pickup_day_of_week, row.is_weekend) == (10, "Saturday", True)
    assert (row.duration_hours, row.avg_speed_mph, row.fare_per_mile, row.tip_percentage) == (0.5, 20.0, 3.36, 9.84)
    assert (row.is_surged, row.is_intercity, row.distance_band) == (False, True, "Long")
    lost = enriched(live(spark, {"pickup_city_id": None, "distance_miles": None, "subtotal": 0.0}), refs).first()
    assert lost.pickup_city is None and lost.is_intercity is None
    assert lost.distance_band == "Very long" and lost.fare_per_mile is None and lost.tip_percentage is None


def test_enriched_constraints_drop(spark):
    events = [{}, {"distance_miles": 0.0}, {"total_fare": -1.0}, {"dropoff_timestamp": "2026-03-07T09:00:00"},
              {"dropoff_timestamp": None, "ride_id": "r2"}, {"ride_id": None}, {"total_fare": None}]
    kept = rides_enriched(live(spark, *events), references(spark))
    assert sorted(r.ride_id for r in kept.collect()) == ["r1", "r2"]


def test_unknown_members(spark):
    dims = dimensions(references(spark))
    unknown = {n: d.where("is_unknown_member").collect() for n, d in dims.items()}
    assert all(len(members) == 1 for members in unknown.values())
    kind = unknown["dim_vehicle_type"][0]
    assert (kind.vehicle_type_key, kind.vehicle_type_name, kind.base_rate, kind.tier_rank) == (-1, "Unknown", None, 99)
    assert unknown["dim_payment_method"][0].is_card is None
    assert unknown["dim_ride_status"][0].is_completed is None
    reason = unknown["dim_cancellation_reason"][0]
    assert (reason.is_not_cancelled, reason.is_actual_cancellation) == (False, False)
    none = dims["dim_cancellation_reason"].where("cancellation_reason_key = 4").first()
    assert (none.cancellation_reason_name, none.is_not_cancelled, none.is_actual_cancellation) == (None, True, False)


def test_fact_falls_back_to_unknown(spark):
    refs = references(spark)
    ids = ["pickup_city_id", "vehicle_type_id", "vehicle_make_id", "payment_method_id", "ride_status_id", "cancellation_reason_id"]
    lost = {**dict.fromkeys(ids), "dropoff_city_id": 99, "ride_id": "r2", "rating": None, "subtotal": 0.0}
    silver = enriched(live(spark, {}, lost, {"ride_id": "r3", "ride_status_id": 2, "cancellation_reason_id": 2}), refs)
    fact = {r.ride_id: r for r in fct_rides(stage_rides(silver), dimensions(refs)).collect()}
    assert len(fact["r1"]) == 48
    assert fact["r1"].is_completed and not fact["r1"].is_cancelled and fact["r1"].was_rated
    assert fact["r1"].fare_per_mile == 33.55 / 10 and fact["r1"].fare_band == "$30 to $60"
    keys = [fact["r2"][k] for k in fact["r2"].asDict() if k.endswith("_key") and k != "date_key"]
    assert keys == [-1] * 7
    assert (fact["r2"].is_completed, fact["r2"].is_cancelled, fact["r2"].tip_percentage) == (False, False, None)
    assert (fact["r3"].is_completed, fact["r3"].is_cancelled) == (False, True)
    assert not {"passenger_name", "driver_phone", "pickup_address", "license_plate"} & set(fact["r1"].asDict())


def test_rate_card_drift(spark):
    rides = live(spark, {}, {"subtotal": 31.5, "total_fare": 34.55}, {"distance_fare": 17.0}, {"vehicle_type_id": 9})
    row, = audit.rate_card_audit(rides, references(spark)).collect()
    assert (row.rides, row.rides_off, row.subtotal_drift, row.distance_fare_off, row.base_fare_off) == (3, 1, 1.0, 1, 0)


def test_published_suites_are_complete():
    def count(suite):
        return sum(
            len(getattr(t, kind)) for t in suite.values()
            for kind in ("unique", "not_null", "relationships", "accepted_values", "accepted_range", "expression")
        )

    assert count(audit.SILVER_TESTS) == 16
    assert count(audit.GOLD_TESTS) == 41 + 1  # and the distance band
    rules = [S.RAW_RULES, S.STAGING_RULES, S.ENRICHED_RULES] + [S.reference_rules(r.key) for r in S.REFERENCES.values()]
    assert sum(map(len, rules)) == 25


def test_filters_reach_the_scan(spark, tmp_path, capsys):
    live(spark, {}).write.parquet(str(tmp_path / "s"))
    rides = spark.read.parquet(str(tmp_path / "s"))
    fact = fct_rides(stage_rides(rides_enriched(rides, references(spark))), dimensions(references(spark)))
    fact.groupBy("pickup_city_key").agg(F.sum("total_fare")).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThan(distance_miles,0.0)" in text and "GreaterThanOrEqual(total_fare,0.0)" in text
    schema = text[text.index("ReadSchema"):]
    assert "passenger_name" not in schema and "vehicle_make_id" in schema
    assert "SortMergeJoin" not in text
