"""Rides derived from the ``orders`` table, one per order, as SQL that Spark and DuckDB share.

The ids run past the reference tables on purpose, some keys are null, and a few
rides break each constraint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import schemas as S

# The reference rows, as their files hold them.
REFERENCE_ROWS = {
    "ref_cities": """
        (1, 'New York', 'NY', 'Northeast'), (2, 'Los Angelas', 'CA', 'West'),
        (3, 'Chicago', 'IL', 'Midwest'), (4, 'Houston', 'TX', 'South'),
        (5, 'Phoenix', 'AZ', 'Southwest'), (6, 'Philadelphia', 'PA', 'Northeast'),
        (7, 'San Antonio', 'TX', 'South'), (8, 'San Diego', 'CA', 'West'),
        (9, 'Dallas', 'TX', 'South'), (10, 'San Jose', 'CA', 'West')""",
    "ref_vehicle_types": """
        (1, 'UberX', 'Standard', 2.5, 1.75, 0.35),
        (2, 'UberXL', 'Extra Large', 3.5, 2.25, 0.45),
        (3, 'UberPOOL', 'Shared Ride', 2, 1.5, 0.3),
        (4, 'Uber Comfort', 'Comfortable', 3, 2, 0.4),
        (5, 'Uber Black', 'Premium', 5, 3.5, 0.6)""",
    "ref_vehicle_makes": """
        (1, 'Toyota'), (2, 'Honda'), (3, 'Ford'), (4, 'Chevrolet'),
        (5, 'Nissan'), (6, 'BMW'), (7, 'Mercedes')""",
    "ref_payment_methods": """
        (1, 'Credit Card', true, true), (2, 'Debit Card', true, true),
        (3, 'Digital Wallet', false, false), (4, 'Cash', false, false)""",
    "ref_ride_statuses": """
        (1, 'Completed', true), (2, 'Cancelled', false), (3, 'In-progress', false)""",
    "ref_cancellation_reasons": """
        (1, 'Driver cancelled'), (2, 'Passenger cancelled'), (3, 'No show'), (4, null)""",
}


def reference_sql(name: str) -> str:
    """A reference table as a query, typed as declared."""
    types = S.REFERENCES[name].types
    columns = ", ".join(f"cast({c} as {'varchar(100)' if k == 'string' else k}) as {c}" for c, k in types.items())
    return f"select {columns} from (values {REFERENCE_ROWS[name]}) as v({', '.join(types)})"


# k is the order, c its customer, s its status. Miles and surge are in hundredths, money is
# in cents; adding 50 before cutting to whole hundreds rounds half up.
RIDES_SQL = """
with numbered as (
    select o_orderkey as k, o_custkey as c, o_orderstatus as s,
           cast(o_orderdate as timestamp) + interval 9131 day
               + o_orderkey % 1440 * interval 1 minute as booked
    from {orders}
),
drawn as (
    select *, cast(k % 6 + 1 as int) as vehicle_type_id,
        k % 5001 as miles, cast(5 + k % 116 as int) as minutes, 100 + k % 151 as surge,
        booked + (1 + k % 10) * interval 1 minute as picked_up
    from numbered
),
carded as (
    select d.*, coalesce(cast(round(r.base_rate * 100) as bigint), 250) as base,
        coalesce(cast(round(r.per_mile * 100) as bigint), 175) as mile,
        coalesce(cast(round(r.per_minute * 100) as bigint), 35) as minute
    from drawn d left join ({cards}) r on d.vehicle_type_id = r.vehicle_type_id
),
metered as (
    select *, cast((miles * mile + 50 - (miles * mile + 50) % 100) / 100 as bigint) as dist,
        minutes * minute as time
    from carded
),
priced as (
    select *, (base + dist + time) * surge + 50 as gross from metered
),
summed as (
    select *,
        cast((gross - gross % 100) / 100 as bigint) + case when k % 499 = 0 then 100 else 0 end as net,
        case when s = 'F' then k % 6 * 100 else 0 end as tip
    from priced
)
select
    concat('R', cast(k as varchar(20))) as ride_id,
    concat('AB', cast(k % 10 as varchar(20)), '-', cast(1000 + k % 9000 as varchar(20)), '-CD42')
        as confirmation_number,
    cast(c as varchar(20)) as passenger_id,
    concat('D', cast(k % 501 as varchar(20))) as driver_id,
    concat('V', cast(k % 307 as varchar(20))) as vehicle_id,
    vehicle_type_id,
    cast(c % 8 + 1 as int) as vehicle_make_id,
    case when c % 50 = 0 then null else cast(c % 4 + 1 as int) end as payment_method_id,
    case s when 'F' then 1 when 'P' then 2 else 3 end as ride_status_id,
    cast(c % 10 + 1 as int) as pickup_city_id,
    cast(k * 7 % 11 + 1 as int) as dropoff_city_id,
    case when s = 'P' then cast(k % 3 + 1 as int) else 4 end as cancellation_reason_id,
    concat('Passenger ', cast(c as varchar(20))) as passenger_name,
    concat('p', cast(c as varchar(20)), '@example.org') as passenger_email,
    '555-0100' as passenger_phone,
    concat('Driver ', cast(k % 501 as varchar(20))) as driver_name,
    cast(10 + k % 41 as double) / 10 as driver_rating,
    '555-0199' as driver_phone,
    concat('DL-', cast(k % 501 as varchar(20))) as driver_license,
    'Corolla' as vehicle_model,
    'Black' as vehicle_color,
    concat('ABC-', cast(k % 307 as varchar(20))) as license_plate,
    concat(cast(k % 900 as varchar(20)), ' Main Street') as pickup_address,
    case when k % 1201 = 0 then 95.5 else cast(2500 + k % 2400 as double) / 100 end as pickup_latitude,
    cast(-12000 + k % 4500 as double) / 100 as pickup_longitude,
    concat(cast(k % 700 as varchar(20)), ' Oak Avenue') as dropoff_address,
    cast(2500 + k % 2300 as double) / 100 as dropoff_latitude,
    cast(-12000 + k % 4600 as double) / 100 as dropoff_longitude,
    cast(miles as double) / 100 as distance_miles,
    minutes as duration_minutes,
    booked as booking_timestamp,
    picked_up as pickup_timestamp,
    case when k % 997 = 0 then picked_up - interval 1 minute
         when s = 'F' then picked_up + minutes * interval 1 minute end as dropoff_timestamp,
    cast(base as double) / 100 as base_fare,
    cast(dist as double) / 100 as distance_fare,
    cast(time as double) / 100 as time_fare,
    cast(surge as double) / 100 as surge_multiplier,
    cast(net as double) / 100 as subtotal,
    cast(tip as double) / 100 as tip_amount,
    cast(net + tip as double) / 100 as total_fare,
    case when s = 'F' then nullif(cast(k % 6 as int), 0) end as rating,
    case when k % 2 = 0 then 'eventhub' else 'bulk_file' end as _source_system,
    booked + interval 2 minute as _ingested_at
from summed
"""


def references(spark: SparkSession) -> dict[str, DataFrame]:
    """The current reference tables."""
    return {name: spark.sql(reference_sql(name)) for name in REFERENCE_ROWS}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def silver_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rides in the silver shape, live ones and bulk ones.

    The few columns of the orders are shuffled before they become wide rides: a file of
    few row groups would else be derived, and read again by all that follows, in few tasks.
    """
    text = RIDES_SQL.replace("{cards}", reference_sql("ref_vehicle_types"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    rides = spark.sql(text, orders=orders.repartition("o_orderkey"))
    return rides.selectExpr(*[f"cast({c} as {kind}) as {c}" for c, kind in S.SILVER_RIDE_TYPES.items()])


def iso(time: Column) -> Column:
    """ISO-8601 in UTC without an offset, as live events carry it."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def payload(rides: DataFrame, offset: str = "") -> Column:
    """The JSON text of a ride event. Bulk files write an offset behind their times."""
    fields = [
        F.concat(iso(F.col(c)), F.lit(offset)).alias(c) if c in S.RIDE_TIMES else F.col(c)
        for c in S.RIDE_FIELDS
    ]
    return F.to_json(F.struct(*fields))


def kafka_records(rides: DataFrame) -> DataFrame:
    """The live rides as topic records. Every tenth of them is sent again a minute later,
    and each thousandth brings an unreadable record along."""
    live = rides.where(F.col("_source_system") == S.LIVE_SOURCE)
    sent = live.select(
        "ride_id",
        payload(live).alias("payload"),
        F.col("booking_timestamp").alias("sent_at"),
        F.substring("ride_id", 2, 20).cast("bigint").alias("k"),
    )

    def record(text: Column, at: Column) -> Column:
        return F.struct(text.alias("payload"), at.alias("sent_at"))

    text, at, k = F.col("payload"), F.col("sent_at"), F.col("k")
    again = F.when(k % 20 == 0, record(text, at + F.expr("interval 1 minute")))
    broken = F.when(k % 2000 == 0, record(F.lit("{bad"), at))
    copies = F.array_compact(F.array(record(text, at), again, broken))
    return sent.select("ride_id", "k", F.inline(copies)).select(
        F.col("ride_id").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"),
        F.lit("rides").alias("topic"),
        (k % 4).cast("int").alias("partition"),
        k.alias("offset"),
        F.col("sent_at").alias("timestamp"),
    )
