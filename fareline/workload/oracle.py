"""The registered queries in SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

from fareline.schemas import REFERENCES
from fareline.workload.rides import REFERENCE_ROWS, RIDES_SQL, reference_sql

NOW = "timestamp '2026-08-01 18:00:30'"
LOADED_UNTIL = "timestamp '2025-06-01 00:00:00'"


def half_up(value: str, places: int) -> str:
    """Round a double half-up on its shortest decimal text, as Spark does."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38,18)), {places}) as double)"


def settled(value: str, places: int = 6) -> str:
    """An aggregate rounded so that the order of summation does not show: the noise goes
    first, then a tie is a tie in every engine."""
    return half_up(f"round(cast({value} as double), {places + 3})", places)


def money(column: str) -> str:
    return f"sum(cast({column} as decimal(18,2)))"


RIDES = RIDES_SQL.replace("{orders}", "orders").replace(
    "{cards}", reference_sql("ref_vehicle_types")
)

WEEKEND = "extract(dow from {0}) in (0, 6)"
DISTANCE_BAND = """case when distance_miles < 3 then 'Short' when distance_miles < 10 then 'Medium'
    when distance_miles < 25 then 'Long' else 'Very long' end"""

DERIVED = f"""
    cast(pickup_timestamp as date) as ride_date,
    cast(extract(hour from pickup_timestamp) as int) as pickup_hour,
    dayname(pickup_timestamp) as pickup_day_of_week,
    {WEEKEND.format('pickup_timestamp')} as is_weekend,
    {half_up('duration_minutes / 60.0', 3)} as duration_hours,
    case when duration_minutes > 0
        then {half_up('distance_miles / (cast(duration_minutes as double) / 60)', 2)} end as avg_speed_mph,
    case when distance_miles > 0 then {half_up('total_fare / distance_miles', 2)} end as fare_per_mile,
    case when subtotal > 0 then {half_up('100 * tip_amount / subtotal', 2)} end as tip_percentage,
    surge_multiplier > 1.0 as is_surged,
    pickup_city_id <> dropoff_city_id as is_intercity,
    {DISTANCE_BAND} as distance_band,
    _ingested_at as _silver_processed_at
"""
KEPT = """ride_id is not null and distance_miles > 0 and total_fare >= 0
    and (dropoff_timestamp is null or dropoff_timestamp >= pickup_timestamp)"""

BASE = f"""
with {', '.join(f'{name} as ({reference_sql(name)})' for name in REFERENCE_ROWS)},
rides as ({RIDES}),
enriched as (
    select rides.*,
        origin.city as pickup_city, origin.state as pickup_state, origin.region as pickup_region,
        destination.city as dropoff_city, destination.state as dropoff_state, destination.region as dropoff_region,
        service.vehicle_type, service.description as vehicle_type_description,
        service.base_rate, service.per_mile, service.per_minute,
        make.vehicle_make, payment.payment_method, payment.is_card, payment.requires_auth,
        outcome.ride_status, outcome.is_completed, reason.cancellation_reason,
        {DERIVED}
    from rides
    left join ref_ride_statuses outcome using (ride_status_id)
    left join ref_cancellation_reasons reason using (cancellation_reason_id)
    left join ref_payment_methods payment using (payment_method_id)
    left join ref_vehicle_makes make using (vehicle_make_id)
    left join ref_vehicle_types service using (vehicle_type_id)
    left join ref_cities origin on rides.pickup_city_id = origin.city_id
    left join ref_cities destination on rides.dropoff_city_id = destination.city_id
),
kept as (select * from enriched where {KEPT}),
dim_city as (
    select city_id as city_key, city_id, city as city_name, state as state_code,
        region as region_name, false as is_unknown_member from ref_cities
    union all select -1, -1, 'Unknown', 'Unknown', 'Unknown', true
),
dim_vehicle_type as (
    select vehicle_type_id as vehicle_type_key, vehicle_type_id, vehicle_type as vehicle_type_name,
        description as vehicle_type_description, base_rate, per_mile as rate_per_mile,
        per_minute as rate_per_minute,
        case vehicle_type when 'UberPOOL' then 1 when 'UberX' then 2 when 'Uber Comfort' then 3
            when 'UberXL' then 4 when 'Uber Black' then 5 else 99 end as tier_rank,
        false as is_unknown_member from ref_vehicle_types
    union all select -1, -1, 'Unknown', 'Unknown', null, null, null, 99, true
),
dim_vehicle_make as (
    select vehicle_make_id as vehicle_make_key, vehicle_make_id,
        vehicle_make as vehicle_make_name, false as is_unknown_member from ref_vehicle_makes
    union all select -1, -1, 'Unknown', true
),
dim_payment_method as (
    select payment_method_id as payment_method_key, payment_method_id,
        payment_method as payment_method_name, is_card, requires_auth,
        false as is_unknown_member from ref_payment_methods
    union all select -1, -1, 'Unknown', null, null, true
),
dim_ride_status as (
    select ride_status_id as ride_status_key, ride_status_id, ride_status as ride_status_name,
        is_completed, false as is_unknown_member from ref_ride_statuses
    union all select -1, -1, 'Unknown', null, true
),
dim_cancellation_reason as (
    select cancellation_reason_id as cancellation_reason_key, cancellation_reason_id,
        cancellation_reason as cancellation_reason_name,
        cancellation_reason_id = 4 as is_not_cancelled,
        cancellation_reason_id <> 4 as is_actual_cancellation,
        false as is_unknown_member from ref_cancellation_reasons
    union all select -1, -1, 'Unknown', false, false, true
),
dim_date as (
    select d as date_key, d as calendar_date,
        cast(year(d) as int) as calendar_year, cast(quarter(d) as int) as calendar_quarter,
        cast(month(d) as int) as calendar_month, cast(day(d) as int) as day_of_month,
        cast(extract(dow from d) + 1 as int) as day_of_week_number,
        cast(weekofyear(d) as int) as week_of_year,
        monthname(d) as month_name, substr(monthname(d), 1, 3) as month_name_short,
        dayname(d) as day_name, substr(dayname(d), 1, 3) as day_name_short,
        concat('Q', quarter(d), ' ', year(d)) as quarter_label,
        concat(substr(monthname(d), 1, 3), ' ', year(d)) as month_label,
        cast(year(d) * 100 + month(d) as int) as year_month_number,
        cast(year(d) * 10 + quarter(d) as int) as year_quarter_number,
        cast(date_trunc('month', d) as date) as first_day_of_month,
        last_day(d) as last_day_of_month,
        {WEEKEND.format('d')} as is_weekend,
        d = date '2026-08-01' as is_today, d <= date '2026-08-01' as is_past
    from (select cast(unnest(range(date '2020-01-01', date '2028-01-01', interval 1 day)) as date) as d)
),
fact as (
    select ride_id, confirmation_number, ride_date as date_key,
        coalesce(origin.city_key, -1) as pickup_city_key, coalesce(destination.city_key, -1) as dropoff_city_key,
        coalesce(service.vehicle_type_key, -1) as vehicle_type_key,
        coalesce(make.vehicle_make_key, -1) as vehicle_make_key,
        coalesce(payment.payment_method_key, -1) as payment_method_key,
        coalesce(outcome.ride_status_key, -1) as ride_status_key,
        coalesce(reason.cancellation_reason_key, -1) as cancellation_reason_key,
        passenger_id, driver_id, vehicle_id, booking_timestamp, pickup_timestamp, dropoff_timestamp,
        pickup_hour, pickup_day_of_week, is_weekend, distance_miles, duration_minutes,
        base_fare, distance_fare, time_fare, subtotal, tip_amount, total_fare, 1 as ride_count,
        surge_multiplier, avg_speed_mph,
        case when distance_miles <> 0 then total_fare / distance_miles end as fare_per_mile,
        case when subtotal <> 0 then tip_amount * 100 / subtotal end as tip_percentage,
        rating as passenger_rating_given, driver_rating as driver_lifetime_rating,
        rating is not null as was_rated, is_surged, is_intercity, distance_band,
        case when total_fare is null then 'Unknown' when total_fare < 15 then 'Under $15'
            when total_fare < 30 then '$15 to $30' when total_fare < 60 then '$30 to $60'
            when total_fare < 120 then '$60 to $120' else '$120 and over' end as fare_band,
        coalesce(outcome.is_completed, false) as is_completed,
        coalesce(reason.is_actual_cancellation, false) as is_cancelled,
        pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
        _source_system, _silver_processed_at, {NOW} as _gold_built_at
    from kept
    left join dim_ride_status outcome using (ride_status_id)
    left join dim_cancellation_reason reason using (cancellation_reason_id)
    left join dim_payment_method payment using (payment_method_id)
    left join dim_vehicle_make make using (vehicle_make_id)
    left join dim_vehicle_type service using (vehicle_type_id)
    left join dim_city origin on kept.pickup_city_id = origin.city_id
    left join dim_city destination on kept.dropoff_city_id = destination.city_id
)
"""

MEASURES = {
    "total_rides": "count(*)",
    "completed_rides": "count(*) filter (is_completed)",
    "cancelled_rides": "count(*) filter (is_cancelled)",
    "completion_rate": settled("count(*) filter (is_completed) / nullif(count(*), 0)"),
    "cancellation_rate": settled("count(*) filter (is_cancelled) / nullif(count(*), 0)"),
    "total_revenue": settled(money("total_fare")),
    "completed_revenue": settled(f"{money('total_fare')} filter (is_completed)"),
    "total_tips": settled(money("tip_amount")),
    "net_subtotal": settled(money("subtotal")),
    "avg_fare": settled("avg(total_fare)"),
    "tip_rate": settled(
        f"cast({money('tip_amount')} as double) / nullif(cast({money('subtotal')} as double), 0)"
    ),
    "surged_rides": "count(*) filter (is_surged)",
    "surge_share": settled("count(*) filter (is_surged) / nullif(count(*), 0)"),
    "avg_surge_multiplier": settled("avg(surge_multiplier) filter (is_surged)"),
    "total_miles": settled(money("distance_miles")),
    "total_hours": settled("sum(duration_minutes) / 60"),
    "intercity_share": settled("count(*) filter (is_intercity) / nullif(count(*), 0)"),
    "rated_rides": "count(*) filter (was_rated)",
    "rating_response_rate": settled(
        "count(*) filter (was_rated) / nullif(count(*) filter (is_completed), 0)"
    ),
    "avg_passenger_rating": settled("avg(passenger_rating_given)"),
    "last_ride_received": "max(pickup_timestamp)",
    "streaming_rides": "count(*) filter (_source_system = 'eventhub')",
    "backfilled_rides": "count(*) filter (_source_system = 'bulk_file')",
}
MINUTES_SINCE = f"date_diff('minute', max(pickup_timestamp), {NOW}) as minutes_since_last_ride"
LAST_24H = f"""(select count(*) from fact
    where pickup_timestamp >= {NOW} - interval 1 day) as rides_last_24_hours"""


def measured(*names: str) -> str:
    return ", ".join(f"{MEASURES[name]} as {name}" for name in names or MEASURES)


def profile(dim: str, subject: str, *roles: str) -> str:
    """Dimension rows with the rides and revenue of each role."""
    columns, joins = "", ""
    for role in roles:
        columns += f", {role}.n as {role}_rides, {settled(f'{role}.r')} as {role}_revenue"
        joins += f""" left join (select {role}_key as key, count(*) as n, {money('total_fare')} as r
            from fact group by 1) {role} on {dim}.{subject}_key = {role}.key"""
    return BASE + f"select {dim}.*{columns} from {dim}{joins}"


def report(table: str, rows: list[tuple[str, str, str]], source: str) -> str:
    """Test report lines from (test, column, counting expression)."""
    return " union all ".join(
        f"select '{table}' as table_name, '{test}' as test, '{column}' as column_name, "
        f"cast({count} as bigint) as failures from {source}"
        for test, column, count in rows
    )


def nulls(*columns: str) -> list[tuple[str, str, str]]:
    return [("not_null", c, f"count(*) filter ({c} is null)") for c in columns]


def unique(table: str, column: str) -> str:
    return f"""select '{table}' as table_name, 'unique' as test, '{column}' as column_name,
        count(*) as failures from (select {column} from {table} where {column} is not null
        group by 1 having count(*) > 1)"""


def related(column: str, parent: str, key: str) -> str:
    return f"""select 'fct_rides' as table_name, 'relationships' as test, '{column}' as column_name,
        count(*) as failures from fact where {column} is not null
        and {column} not in (select {key} from {parent})"""


def failing(name: str, conditions: dict[str, tuple[str, str]], source: str) -> str:
    rows = [(test, c, f"count(*) filter ({bad})") for c, (test, bad) in conditions.items()]
    return report(name, rows, source)


ROLE_PARENTS = {
    "date_key": ("dim_date", "date_key"),
    "pickup_city_key": ("dim_city", "city_key"),
    "dropoff_city_key": ("dim_city", "city_key"),
    "vehicle_type_key": ("dim_vehicle_type", "vehicle_type_key"),
    "vehicle_make_key": ("dim_vehicle_make", "vehicle_make_key"),
    "payment_method_key": ("dim_payment_method", "payment_method_key"),
    "ride_status_key": ("dim_ride_status", "ride_status_key"),
    "cancellation_reason_key": ("dim_cancellation_reason", "cancellation_reason_key"),
}
DIM_KEYS = {table: key for table, key in ROLE_PARENTS.values()}

GOLD_SUITE = " union all ".join(
    [
        *[unique(table, key) for table, key in DIM_KEYS.items()],
        *[report(table, nulls(key), table) for table, key in DIM_KEYS.items()],
        report("dim_city", nulls("city_name"), "dim_city"),
        failing(
            "dim_vehicle_type",
            {"tier_rank": ("accepted_range", "tier_rank < 1 or tier_rank > 99")},
            "dim_vehicle_type",
        ),
        failing(
            "dim_ride_status",
            {
                "ride_status_name": (
                    "accepted_values",
                    "ride_status_name not in ('Completed', 'Cancelled', 'In-progress', 'Unknown')",
                )
            },
            "dim_ride_status",
        ),
        unique("fact", "ride_id").replace("'fact'", "'fct_rides'"),
        report("fct_rides", nulls("ride_id", *ROLE_PARENTS, "total_fare"), "fact"),
        *[related(column, *parent) for column, parent in ROLE_PARENTS.items()],
        failing(
            "fct_rides",
            {
                "total_fare": ("accepted_range", "total_fare < 0"),
                "distance_miles": ("accepted_range", "distance_miles < 0 or distance_miles > 100"),
                "surge_multiplier": ("accepted_range", "surge_multiplier < 1 or surge_multiplier > 3"),
                "fare_band": (
                    "accepted_values",
                    "fare_band not in ('Under $15', '$15 to $30', '$30 to $60', '$60 to $120',"
                    " '$120 and over', 'Unknown')",
                ),
                "_source_system": ("accepted_values", "_source_system not in ('eventhub', 'bulk_file')"),
                "distance_band": (
                    "accepted_values",
                    "distance_band not in ('Short', 'Medium', 'Long', 'Very long')",
                ),
            },
            "fact",
        ),
    ]
)

REF_KEYS = {
    "ref_cities": "city_id",
    "ref_vehicle_types": "vehicle_type_id",
    "ref_vehicle_makes": "vehicle_make_id",
    "ref_payment_methods": "payment_method_id",
    "ref_ride_statuses": "ride_status_id",
    "ref_cancellation_reasons": "cancellation_reason_id",
}
SILVER_SUITE = " union all ".join(
    [
        *[unique(table, key) for table, key in REF_KEYS.items()],
        *[report(table, nulls(key), table) for table, key in REF_KEYS.items()],
        unique("kept", "ride_id").replace("'kept'", "'rides_enriched'"),
        report("rides_enriched", nulls("ride_id", "pickup_timestamp"), "kept"),
        failing("rides_enriched", {"total_fare": ("expression", "not total_fare >= 0")}, "kept"),
    ]
)


def tallied(rules: list[tuple[str, str, str]], source: str) -> str:
    return " union all ".join(
        f"""select '{name}' as "constraint", '{action}' as action,
            count(*) filter (not coalesce({condition}, false)) as violations,
            count(*) filter (coalesce({condition}, false)) as passed from {source}"""
        for name, condition, action in rules
    )


ENRICHED_RULES = [
    ("valid_ride_id", "ride_id is not null", "drop"),
    ("positive_distance", "distance_miles > 0", "drop"),
    ("non_negative_total", "total_fare >= 0", "drop"),
    ("coherent_timestamps", "dropoff_timestamp is null or dropoff_timestamp >= pickup_timestamp", "drop"),
    (
        "fare_reconciles",
        "abs(subtotal - round((base_fare + distance_fare + time_fare) * surge_multiplier, 2)) < 0.05",
        "warn",
    ),
    ("cancelled_has_reason", "ride_status_id = 1 or cancellation_reason_id between 1 and 3", "warn"),
    ("pickup_in_range", "pickup_latitude between -90 and 90", "warn"),
]
STAGING_RULES = [
    ("valid_ride_id", "ride_id is not null", "drop"),
    ("valid_booking_time", "booking_timestamp is not null", "drop"),
    ("plausible_surge", "surge_multiplier between 1.0 and 3.0", "warn"),
    ("plausible_rating", "rating is null or rating between 1 and 5", "warn"),
    ("non_negative_fare", "total_fare >= 0", "warn"),
]
NUMBER = "cast(substr(ride_id, 2) as bigint)"
FLAWED = f"""flawed as (
    select * replace (
        case when {NUMBER} % 211 = 0 then 3.5 else surge_multiplier end as surge_multiplier,
        case when {NUMBER} % 307 = 0 then 6 else rating end as rating,
        case when {NUMBER} % 401 = 0 then -1.0 else total_fare end as total_fare,
        case when {NUMBER} % 503 <> 0 then booking_timestamp end as booking_timestamp
    ) from rides
)"""

CITY_FEED = f"""
with ref_cities as ({reference_sql('ref_cities')}),
feed as (
    select o_custkey % 10 + 1 as id, o_orderkey as k,
        case when o_orderkey % 7 = 0 then '0' else '' end || (o_custkey % 10 + 1) as raw_id,
        city, state, concat(region, ' ', o_orderkey % 100) as region,
        concat('map_cities_', o_orderkey, '.json') as _source_file,
        o_orderdate as modified
    from orders join ref_cities on city_id = o_custkey % 10 + 1
)
"""


def newest_city(key: str) -> str:
    return CITY_FEED + f"""
        , latest as (select * from feed qualify row_number() over (
            partition by {key} order by modified desc, _source_file desc) = 1)
        select cast(id as int) as city_id, city, state, region, _source_file,
            modified + interval 1 minute as _bronze_ingested_at,
            count(*) over (partition by id) as _key_occurrences from latest"""


def to_date_credit(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    match = f" and f.{by} = g.{by}" if by else ""
    groups = f"(select distinct {by} from fact) g, dim_date d" if by else "dim_date d"
    picked = f"g.{by}, " if by else ""
    return BASE + f"""
        select {picked}d.date_key, {settled(money('total_fare'))} as revenue_mtd
        from {groups} join fact f on f.date_key between d.first_day_of_month and d.date_key{match}
        group by {'all' if by else 'd.date_key'}"""


def month_pairs(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    same = f" and c.{by} = p.{by}" if by else ""
    picked = f"coalesce(c.{by}, p.{by}) as {by}, " if by else ""
    return BASE + f"""
        , months as (select {keys}first_day_of_month as m, {money('total_fare')} as r
            from fact join dim_date using (date_key) group by all),
        paired as (select {picked}coalesce(c.m, cast(p.m + interval 1 month as date)) as first_day_of_month,
            c.r as cur, p.r as prev
            from months c full join months p on c.m = cast(p.m + interval 1 month as date){same})
        select {keys}first_day_of_month, {settled('cur', 6)} as current, {settled('prev', 6)} as prior,
            {settled('(cast(coalesce(cur, 0) as double) - cast(prev as double)) / cast(prev as double)')} as change
        from paired where first_day_of_month in (select first_day_of_month from dim_date)"""


def rolling(by: str = "") -> str:
    keys = f"{by}, " if by else ""
    return BASE + f"""
        select {keys}d.date_key, count(*) as rides_7d from dim_date d
        join (select fact.* from fact join dim_date using (date_key)) f
            on f.date_key between d.date_key - 6 and d.date_key
        group by all"""


LOADED_TWICE = f"""
, base as (select ride_id, date_key, ride_status_key, total_fare, _silver_processed_at as stamped from fact),
first_load as (select * from base where stamped <= {LOADED_UNTIL}),
again as (
    select ride_id, cast(date_key + 1 as date) as date_key, 1 as ride_status_key,
        total_fare + 1 as total_fare, stamped + interval 2 day as stamped
    from base where {NUMBER} % 7 = 0
),
fresh as (
    select * from (select * from base union all select * from again)
    where stamped > (select max(stamped) from first_load) - interval 1 hour
),
batch as (select * from fresh qualify row_number() over (partition by ride_id order by stamped desc) = 1),
second as (
    select * from first_load where ride_id not in (select ride_id from batch)
    union all select * from batch
)
"""

RESCUE_LINE = """
    select ride_id, k, case when k % 11 = 0 then 'mistyped' when k % 13 = 0 then 'unknown'
        when k % 17 = 0 then 'broken' else 'good' end as kind,
        case when k % 11 <> 0 and k % 13 <> 0 and k % 17 <> 0 and k % 19 = 0 then 2 else 1 end as copies
    from (select concat('R', o_orderkey) as ride_id, o_orderkey as k from orders)
"""

ORACLE: dict[str, str] = {
    "revenue_by_city_month": BASE
    + f"""select pickup_city_key, city_name, year_month_number,
        {measured('total_rides', 'completed_rides', 'total_revenue', 'completed_revenue', 'avg_fare')}
        from fact join dim_city on pickup_city_key = city_key left join dim_date using (date_key)
        group by all""",
    "rides_enriched": BASE + "select * from kept",
    "distance_band_mix": BASE
    + f"""select distance_band, count(*) as rides, {settled(money('distance_miles'))} as miles,
        {settled('sum(cast(duration_hours as decimal(18,3)))')} as hours,
        {settled('avg(avg_speed_mph)')} as avg_speed_mph,
        {settled('avg(tip_percentage)')} as avg_tip_percentage,
        count(*) filter (is_intercity) as intercity_rides from kept group by 1""",
    "weekend_hour_profile": BASE
    + f"""select is_weekend, pickup_day_of_week, pickup_hour,
        {measured('total_rides', 'avg_fare', 'surge_share')} from fact group by all""",
    "fct_rides": BASE + "select * from fact",
    "fare_band_mix": BASE
    + f"""select fare_band, {measured('total_rides', 'total_revenue', 'avg_fare', 'tip_rate',
        'avg_surge_multiplier')} from fact group by 1""",
    "dim_city": profile("dim_city", "city", "pickup_city", "dropoff_city"),
    "dim_vehicle_type": profile("dim_vehicle_type", "vehicle_type", "vehicle_type"),
    "dim_vehicle_make": profile("dim_vehicle_make", "vehicle_make", "vehicle_make"),
    "dim_payment_method": profile("dim_payment_method", "payment_method", "payment_method"),
    "dim_ride_status": profile("dim_ride_status", "ride_status", "ride_status"),
    "dim_cancellation_reason": profile(
        "dim_cancellation_reason", "cancellation_reason", "cancellation_reason"
    ),
    "dim_date": BASE
    + f"""select dim_date.*, n as rides, {settled('r')} as revenue from dim_date
        left join (select date_key, count(*) as n, {money('total_fare')} as r from fact group by 1)
        using (date_key)""",
    "ref_latest_version": newest_city("id"),
    "ref_key_occurrences": newest_city("raw_id"),
    "latest_line_per_key": """
        select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
            order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc,
            l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
            l_linestatus desc) = 1""",
    "expect_drop_enriched": BASE
    + f"""select ride_status_id, _source_system, count(*) as rides,
        {settled(money('total_fare'))} as revenue from kept group by all""",
    "expect_warn_counts": BASE + tallied(ENRICHED_RULES, "rides"),
    "expect_staging": BASE
    + f""", {FLAWED}, tested as (select * replace (
            case when {NUMBER} % 601 <> 0 then ride_id end as ride_id) from flawed)
        {tallied(STAGING_RULES, 'tested')}""",
    "staging_from_json": BASE
    + f""", {FLAWED}
        select * exclude (_ingested_at) replace (case when _source_system = 'eventhub'
            then coalesce(booking_timestamp, pickup_timestamp) else booking_timestamp end
            as booking_timestamp)
        from flawed where _source_system = 'eventhub' or booking_timestamp is not null""",
    "dq_gold_suite": BASE + GOLD_SUITE,
    "dq_silver_suite": BASE + SILVER_SUITE,
    "dq_unique": """select concat(l_orderkey, '-', l_linenumber) as line_key, count(*) as rows
        from lineitem group by 1 having count(*) > 1""",
    "dq_not_null": BASE
    + report(
        "staging_rides",
        nulls("ride_id", "payment_method_id", "dropoff_timestamp", "rating", "total_fare"),
        "rides",
    ),
    "dq_relationships": BASE
    + " union all ".join(
        f"""select '{column}' as column_name, {column} as key, count(*) as rows from rides
        where {column} is not null and {column} not in (select {key} from {parent}) group by 2"""
        for column, (parent, key) in {
            "dropoff_city_id": ("ref_cities", "city_id"),
            "vehicle_type_id": ("ref_vehicle_types", "vehicle_type_id"),
            "vehicle_make_id": ("ref_vehicle_makes", "vehicle_make_id"),
            "payment_method_id": ("ref_payment_methods", "payment_method_id"),
        }.items()
    ),
    "dq_accepted_values": failing(
        "orders",
        {
            "o_orderstatus": ("accepted_values", "o_orderstatus not in ('F', 'O')"),
            "o_orderpriority": ("accepted_values", "o_orderpriority not in ('1-URGENT', '2-HIGH')"),
        },
        "orders",
    ),
    "dq_accepted_range": BASE
    + failing(
        "staging_rides",
        {
            "distance_miles": ("accepted_range", "distance_miles < 0 or distance_miles > 49.5"),
            "surge_multiplier": ("accepted_range", "surge_multiplier < 1.1"),
            "rating": ("accepted_range", "rating < 2 or rating > 4"),
            "total_fare": ("accepted_range", "total_fare > 300"),
        },
        "rides",
    ),
    "dq_expression": failing(
        "lineitem",
        {
            "l_quantity": ("expression", "not l_quantity <= 45"),
            "l_extendedprice": ("expression", "not l_extendedprice * (1 - l_discount) > 20000"),
        },
        "lineitem",
    ),
    "freshness": BASE
    + f""", newest as (select _source_system, max(_silver_processed_at) as last_loaded_at
            from kept group by 1)
        select *, date_diff('second', last_loaded_at, {NOW}) as age_seconds,
            case when date_diff('second', last_loaded_at, {NOW}) > 10800 then 'error'
                when date_diff('second', last_loaded_at, {NOW}) > 1800 then 'warn' else 'pass' end
                as status from newest""",
    "rate_card_audit": BASE
    + f""", money as (
            select vehicle_type_id, cast(distance_miles as decimal(18,2)) as miles,
                cast(surge_multiplier as decimal(18,2)) as surge, duration_minutes as minutes,
                cast(r.base_rate as decimal(18,2)) as base,
                cast(r.per_mile as decimal(18,2)) as mile, cast(r.per_minute as decimal(18,2)) as minute,
                cast(rides.base_fare as decimal(18,2)) as base_fare,
                cast(distance_fare as decimal(18,2)) as distance_fare,
                cast(time_fare as decimal(18,2)) as time_fare, cast(subtotal as decimal(18,2)) as subtotal,
                cast(tip_amount as decimal(18,2)) as tip, cast(total_fare as decimal(18,2)) as total
            from rides join ref_vehicle_types r using (vehicle_type_id)),
        parts as (select *, round(miles * mile, 2) as d, round(minutes * minute, 2) as t from money),
        quoted as (select *, round((base + d + t) * surge, 2) as net from parts)
        select vehicle_type_id, count(*) as rides,
            count(*) filter (abs(subtotal - net) >= 0.05) as rides_off,
            {settled('sum(subtotal - net)')} as subtotal_drift,
            {settled('max(abs(total - net - tip))')} as largest_total_drift,
            count(*) filter (base_fare <> base) as base_fare_off,
            count(*) filter (distance_fare <> d) as distance_fare_off,
            count(*) filter (time_fare <> t) as time_fare_off from quoted group by 1""",
    "kpi_overall": BASE + f"select {measured()}, {MINUTES_SINCE}, {LAST_24H} from fact",
    "kpi_by_vehicle_type": BASE
    + f"""select vehicle_type_name, tier_rank, {measured()} from fact
        join dim_vehicle_type using (vehicle_type_key) group by all""",
    "kpi_by_source": BASE + f"select _source_system, {measured()}, {MINUTES_SINCE} from fact group by all",
    "kpi_by_city_pair": BASE
    + f"""select pu.city_name as pickup_city, dr.city_name as dropoff_city,
        {measured('total_rides', 'total_revenue', 'total_miles', 'total_hours', 'intercity_share')}
        from fact join dim_city pu on pickup_city_key = pu.city_key
        join dim_city dr on dropoff_city_key = dr.city_key group by all""",
    "rides_last_24h": BASE
    + f"""select ride_status_key, {measured('total_rides', 'last_ride_received')},
        {MINUTES_SINCE}, {LAST_24H} from fact group by 1""",
    "revenue_mtd": to_date_credit(),
    "revenue_mtd_by_city": to_date_credit("pickup_city_key"),
    "avg_fare_mtd": BASE
    + f"""select d.date_key, {settled('avg(f.total_fare)')} as avg_fare_mtd from dim_date d
        join fact f on f.date_key between date_trunc('month', d.date_key) and d.date_key
        join dim_date listed on listed.date_key = f.date_key group by 1""",
    "revenue_mom": month_pairs(),
    "revenue_mom_by_vehicle_make": month_pairs("vehicle_make_key"),
    "revenue_same_day_prior_month": BASE
    + f"""select d.date_key, {settled(money('total_fare'))} as prior_revenue from dim_date d
        join fact f on f.date_key = cast(d.date_key - interval 1 month as date)
        join dim_date p on p.date_key = f.date_key group by 1""",
    "rides_rolling_7d": rolling(),
    "rides_rolling_7d_by_source": rolling("_source_system"),
    "look_back_filter": BASE
    + f"""select _source_system, count(*) as rides, min(_silver_processed_at) as oldest,
        {settled(money('total_fare'))} as revenue from kept
        where _silver_processed_at > (select max(_silver_processed_at) from kept
            where _silver_processed_at <= {LOADED_UNTIL}) - interval 1 hour group by 1""",
    "fct_upsert": BASE
    + LOADED_TWICE
    + f"""select ride_id, date_key, ride_status_key, {settled('total_fare', 2)} as total_fare,
        stamped as _silver_processed_at from second""",
    "fct_upsert_ties": BASE
    + f"""select ride_id, date_key, ride_status_key,
        {settled(f"case when {NUMBER} % 4 = 0 and {NUMBER} % 3 = 2 then total_fare + 1 else total_fare end", 2)}
            as total_fare, _silver_processed_at, cast(1 as int) as version from fact""",
    "schema_append": BASE
    + f"""select ride_id, date_key, total_fare,
        case when {NUMBER} % 5 <> 0 then fare_band end as fare_band,
        case when {NUMBER} % 5 = 0 then concat('P', {NUMBER} % 3) end as promo_code from fact""",
    "table_changes": BASE
    + LOADED_TWICE
    + f""", changes as (
            select 'insert' as _change_type, * from second
                where ride_id not in (select ride_id from first_load)
            union all select 'update_preimage', o.* from first_load o join second n using (ride_id)
                where o is distinct from n
            union all select 'update_postimage', n.* from first_load o join second n using (ride_id)
                where o is distinct from n)
        select _change_type, ride_id, date_key, ride_status_key, {settled('total_fare', 2)} as total_fare
        from changes""",
    "rescued_data": f"""
        with lines as ({RESCUE_LINE}), copies as (
            select lines.* from lines, range(copies))
        select k, case when kind <> 'broken' then ride_id end as ride_id,
            cast(case kind when 'good' then k % 5 + 1 when 'unknown' then 4 end as int) as rating,
            case when kind = 'good' then false end as is_test,
            case kind when 'mistyped' then '{{"rating":"five"}}'
                when 'unknown' then concat('{{"promo":"X', k % 3, '"}}')
                when 'broken' then concat('{{"_corrupt_record":"{{\\"ride_id\\":\\"', ride_id, '\\", broken"}}')
                end as _rescued_data
        from copies""",
    "stream_dedup": BASE + "select * exclude (_ingested_at) from rides where _source_system = 'eventhub'",
    "stream_bronze": """
        with live as (select o_orderkey as k, cast(o_orderdate as timestamp) + interval 9131 day
                + o_orderkey % 1440 * interval 1 minute as sent from orders where o_orderkey % 2 = 0),
        records as (select k, sent, 0 as bad from live
            union all select k, sent + interval 1 minute, 0 from live where k % 20 = 0
            union all select k, sent, 1 from live where k % 2000 = 0)
        select 'rides' as kafka_topic, cast(k % 4 as int) as kafka_partition, count(*) as records,
            min(k) as first_offset, max(k) as last_offset, max(sent) as last_enqueued_at,
            count(*) filter (bad = 1) as unreadable, max(concat('R', k)) as last_key,
            cast(0 as bigint) as unmarked from records group by 2""",
    "stream_constraint_counts": BASE
    + f""", {FLAWED}, live as (
            select * replace (coalesce(booking_timestamp, pickup_timestamp) as booking_timestamp)
            from flawed where _source_system = 'eventhub'),
        staged as ({tallied(STAGING_RULES, 'live')})
        select 'flow_stream_rides_arrived' as measured, 'rows' as metric, count(*)
                + count(*) filter ({NUMBER} % 20 = 0) + count(*) filter ({NUMBER} % 2000 = 0) as total from live
            union all select 'flow_stream_rides_arrived', 'valid_ride_id', count(*) filter ({NUMBER} % 2000 = 0) from live
            union all select 'flow_stream_rides', 'rows', count(*) from live
            union all select 'flow_stream_rides', "constraint", violations from staged
            union all select 'state', 'rows_behind_watermark', 0""",
    "append_flows": BASE + "select * exclude (_ingested_at) from rides",
    "stream_static_join": BASE
    + """select * exclude (_ingested_at, _silver_processed_at) from kept
        where _source_system = 'eventhub'""",
    "schema_evolution": BASE
    + f"""select ride_id, total_fare, cast(duration_minutes as bigint) as duration_minutes,
        case when {NUMBER} % 3 = 0 then concat('P', {NUMBER} % 7) end as promo_code,
        cast(null as varchar) as _rescued_data from rides""",
    "landing_again": BASE
    + f"""select concat('rides_', {NUMBER} % 3, '.json') as file_name, color as vehicle_color, count(*) as rows,
            count(distinct ride_id) as rides
        from rides, (values ('Black'), ('Blue')) as c(color)
        where _source_system = 'bulk_file' and (color = 'Black' or {NUMBER} % 3 = 1) group by all""",
    "manifest_landing": BASE
    + """select 'bulk_rides' as folder_name, count(*) as lines, count(*) as rides
            from rides where _source_system = 'bulk_file'"""
    + "".join(
        f" union all select '{ref.source}', count(*), 0 from {name}"
        for name, ref in REFERENCES.items()
    ),
    "end_to_end_kpi": BASE
    + f"""select _source_system, vehicle_type_key, {measured('total_rides', 'completed_rides',
        'cancelled_rides', 'total_revenue', 'avg_fare', 'rated_rides')} from fact group by all""",
}
