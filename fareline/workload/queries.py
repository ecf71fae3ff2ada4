"""The registered queries. Each takes (spark, folder of test tables) and returns a DataFrame.

All of them read whole tables. Rides come from ``orders`` (see ``rides``); times that
would otherwise be the clock's are taken from the data, so that results repeat.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.operators.expectations import tally
from fareline.operators.lookup import lookup, orphans
from fareline.operators.measures import measure, rides as ride_count, rounded, with_rides_last_24_hours
from fareline.operators.periods import (
    month_over_month,
    month_to_date,
    rolling_days,
    same_day_prior_month,
)
from fareline.operators.quality import TableTests, check_rows, freshness, repeated_keys, run_tests
from fareline.operators.upsert import newer_than, table_changes as row_changes
from fareline.operators.versions import first_per_key
from fareline.plans import audit
from fareline.plans.enrich import rides_enriched
from fareline.plans.reference import checked_reference, current_reference, reference_tables
from fareline.plans.staging import bulk_rides, live_rides, staged
from fareline.plans.star import (
    DIMENSIONS,
    ROLES,
    dim_date,
    dimension,
    dimensions,
    fct_rides,
    stage_rides,
)
from fareline.session import no_shuffles_left, prepare, scratch
from fareline.sources.json_files import parse
from fareline.sources.kafka import bronze_rides
from fareline.sources.landing import land, landed_folder, read_manifest
from fareline.sources.storage import remove, write_lines
from fareline.sources.tables import KeyedTable, rebuild
from fareline.streaming import flows
from fareline.streaming.metrics import FlowMetrics, flow_totals
from fareline.workload.rides import (
    kafka_records,
    payload,
    reference_sql,
    references,
    silver_rides,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The moment at which clock-bound measures are taken, and the first load's end.
NOW = "2026-08-01 18:00:30"
LOADED_UNTIL = "2025-06-01 00:00:00"


def query(function: Query, name: str | None = None) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[name or function.__name__] = run
    return run


def named(name: str) -> Callable[[Query], Query]:
    return lambda function: query(function, name)


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def ingest_time() -> Column:
    return F.col("_ingested_at")


def ride_number(ride: str = "ride_id") -> Column:
    return F.substring(ride, 2, 20).cast("bigint")


def today() -> Column:
    return F.lit(NOW[:10]).cast("date")


_STORED: dict[tuple[str, str, str], str] = {}


def silver_table(spark: SparkSession, sf_dir: str, name: str, build: Query) -> DataFrame:
    """A silver table in shared storage, written when a session first asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORED:
        path = scratch(spark, f"silver-{name}")
        rebuild(build(spark, sf_dir), path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def rides_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rides, derived from ``orders`` once and stored, as a silver table is."""
    return silver_table(spark, sf_dir, "rides", silver_rides)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rides: all seven joins and the drop rules, stored once for gold."""
    return silver_table(
        spark, sf_dir, "rides_enriched", lambda s, d: rides_enriched(rides_table(s, d), references(s), ingest_time())
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = stage_rides(silver(spark, sf_dir))
    return fct_rides(rides, dimensions(references(spark)), built_at=now())


def one_dimension(spark: SparkSession, name: str) -> DataFrame:
    return dimension(name, spark.sql(reference_sql(DIMENSIONS[name].ref)))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table in shared storage, for work that reads them several times."""
    path = scratch(df.sparkSession, purpose)
    rebuild(df, path)
    return df.sparkSession.read.parquet(path)


def calendar(spark: SparkSession) -> DataFrame:
    return dim_date(spark, today())


# Star and enrichment -------------------------------------------------------------


@query
def revenue_by_city_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = one_dimension(spark, "dim_city")
    rides = lookup(fact(spark, sf_dir), city, "pickup_city_key", "city_key", city_name="city_name")
    # Rides off the calendar stay, under a month of null.
    dated = rides.join(calendar(spark).select("date_key", "year_month_number"), "date_key", "left")
    names = ["total_rides", "completed_rides", "total_revenue", "completed_revenue", "avg_fare"]
    return rounded(measure(dated, names, ["pickup_city_key", "city_name", "year_month_number"]))


@named("rides_enriched")
def rides_enriched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_enriched(rides_table(spark, sf_dir), references(spark), ingest_time())


@query
def distance_band_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = silver(spark, sf_dir)
    return rounded(
        rides.groupBy("distance_band").agg(
            F.count(F.lit(1)).alias("rides"),
            F.sum("distance_miles").alias("miles"),
            F.sum("duration_hours").alias("hours"),
            F.avg("avg_speed_mph").alias("avg_speed_mph"),
            F.avg("tip_percentage").alias("avg_tip_percentage"),
            F.count_if("is_intercity").alias("intercity_rides"),
        )
    )


@query
def weekend_hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["is_weekend", "pickup_day_of_week", "pickup_hour"]
    return rounded(measure(fact(spark, sf_dir), ["total_rides", "avg_fare", "surge_share"], by))


@named("fct_rides")
def fct_rides_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir)


@query
def fare_band_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["total_rides", "total_revenue", "avg_fare", "tip_rate", "avg_surge_multiplier"]
    return rounded(measure(fact(spark, sf_dir), names, ["fare_band"]))


def dimension_profile(name: str) -> Query:
    """A dimension's rows with the rides and revenue of each member, per role."""
    roles = [key for key, (_, dim) in ROLES.items() if dim == name]

    def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
        rides, members = fact(spark, sf_dir), one_dimension(spark, name)
        for key in roles:
            role = key.removesuffix("_key")
            used = rides.groupBy(key).agg(
                F.count(F.lit(1)).alias("rides"), F.sum("total_fare").alias("revenue")
            )
            columns = {f"{role}_rides": "rides", f"{role}_revenue": "revenue"}
            members = lookup(members, used, DIMENSIONS[name].key, key, **columns)
        return rounded(members)

    return profile


for _name in DIMENSIONS:
    query(dimension_profile(_name), _name)


@named("dim_date")
def dim_date_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = measure(fact(spark, sf_dir), ["total_rides", "total_revenue"], ["date_key"])
    columns = {"rides": "total_rides", "revenue": "total_revenue"}
    return rounded(lookup(calendar(spark), used, "date_key", "date_key", **columns))


# Reference versions --------------------------------------------------------------


def city_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze map_cities after many landings: every order re-lands its customer's city, some
    with a padded key and some with a corrected region."""
    orders = table(spark, sf_dir, "orders")
    number = F.col("o_orderkey")
    landed = orders.select(
        (F.col("o_custkey") % 10 + 1).cast("int").alias("id"),
        number.alias("k"),
        F.col("o_orderdate").cast("timestamp").alias("_source_modified_at"),
    )
    cities = lookup(
        landed, references(spark)["ref_cities"], "id", "city_id", city="city", state="state", region="region"
    )
    return cities.select(
        F.concat(F.when(F.col("k") % 7 == 0, "0").otherwise(""), F.col("id")).alias("city_id"),
        "city",
        "state",
        F.concat("region", F.lit(" "), F.col("k") % 100).alias("region"),
        F.concat(F.lit("map_cities_"), F.col("k"), F.lit(".json")).alias("_source_file"),
        "_source_modified_at",
        F.expr("_source_modified_at + interval 1 minute").alias("_ingested_at"),
    )


@query
def ref_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = city_feed(spark, sf_dir).withColumn("city_id", F.ltrim("city_id", F.lit("0")))
    return checked_reference(plain, S.REFERENCES["ref_cities"]).drop("_silver_processed_at")


@query
def ref_key_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = city_feed(spark, sf_dir)
    return current_reference(feed, S.REFERENCES["ref_cities"]).drop("_silver_processed_at")


@query
def latest_line_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [F.col(c).desc() for c in ("l_shipdate", *[c for c in lines.columns if c not in keys])]
    return first_per_key(lines, keys, rest)


# Constraints ---------------------------------------------------------------------


@query
def expect_drop_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = silver(spark, sf_dir)
    return rounded(
        kept.groupBy("ride_status_id", "_source_system").agg(
            F.count(F.lit(1)).alias("rides"), F.sum("total_fare").alias("revenue")
        )
    )


@query
def expect_warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(rides_table(spark, sf_dir), S.ENRICHED_RULES)


def bulk_lines(rides: DataFrame) -> DataFrame:
    """Lines of the bulk ride files."""
    bulk = rides.where(F.col("_source_system") == S.BULK_SOURCE)
    return bulk.select(payload(bulk, offset="+00:00").alias("value"), ride_number().alias("k"))


def flawed(rides: DataFrame) -> DataFrame:
    """Rides of which some break the staging constraints."""
    k = ride_number()
    return rides.withColumns(
        {
            "surge_multiplier": F.when(k % 211 == 0, 3.5).otherwise(F.col("surge_multiplier")),
            "rating": F.when(k % 307 == 0, 6).otherwise(F.col("rating")),
            "total_fare": F.when(k % 401 == 0, -1.0).otherwise(F.col("total_fare")),
            "booking_timestamp": F.when(k % 503 != 0, F.col("booking_timestamp")),
        }
    )


@query
def expect_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = rides_table(spark, sf_dir)
    dropped = flawed(rides)
    return tally(dropped.withColumn("ride_id", F.when(ride_number() % 601 != 0, F.col("ride_id"))), S.STAGING_RULES)


@query
def staging_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources as JSON text, parsed, typed, de-duplicated, checked and united."""
    root = scratch(spark, "staging-from-json")
    rides = flawed(rides_table(spark, sf_dir))
    booked = F.coalesce("booking_timestamp", "pickup_timestamp")
    kafka_records(rides.withColumn("booking_timestamp", booked)).write.parquet(f"{root}/topic")
    bulk_lines(rides).select("value").write.text(f"{root}/raw")

    records = spark.read.parquet(f"{root}/topic")
    live = staged(live_rides(bronze_rides(records)))
    lines = spark.read.text(f"{root}/raw").withColumn("_ingested_at", F.current_timestamp())
    ride = F.from_json("value", S.RIDE_DDL).alias("ride")
    bulk = staged(bulk_rides(lines.select(ride, "_ingested_at").select("ride.*", "_ingested_at")))
    return live.unionByName(bulk).drop("_ingested_at")


# Table tests ---------------------------------------------------------------------


@query
def dq_gold_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(references(spark))
    tables = {**dims, "dim_date": calendar(spark), "fct_rides": fact(spark, sf_dir)}
    return run_tests(tables, audit.GOLD_TESTS)


@query
def dq_silver_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = rides_enriched(rides_table(spark, sf_dir), references(spark), ingest_time())
    return run_tests({**references(spark), "rides_enriched": rides}, audit.SILVER_TESTS)


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keyed = lines.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"))
    return repeated_keys(keyed, "line_key")


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["ride_id", "payment_method_id", "dropoff_timestamp", "rating", "total_fare"]
    return check_rows("staging_rides", rides_table(spark, sf_dir), TableTests(not_null=columns))


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides, refs = rides_table(spark, sf_dir), references(spark)
    parents = {
        "dropoff_city_id": ("ref_cities", "city_id"),
        "vehicle_type_id": ("ref_vehicle_types", "vehicle_type_id"),
        "vehicle_make_id": ("ref_vehicle_makes", "vehicle_make_id"),
        "payment_method_id": ("ref_payment_methods", "payment_method_id"),
    }
    lost = orphans(rides, {column: (refs[parent], key) for column, (parent, key) in parents.items()})
    return lost.withColumn("key", F.col("key").cast("int"))


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = TableTests(
        accepted_values={"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH"]}
    )
    return check_rows("orders", table(spark, sf_dir, "orders"), tests)


@query
def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = TableTests(
        accepted_range={
            "distance_miles": (0, 49.5),
            "surge_multiplier": (1.1, None),
            "rating": (2, 4),
            "total_fare": (None, 300),
        }
    )
    return check_rows("staging_rides", rides_table(spark, sf_dir), tests)


@query
def dq_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    conditions = {
        "l_quantity": "l_quantity <= 45",
        "l_extendedprice": "l_extendedprice * (1 - l_discount) > 20000",
    }
    return check_rows("lineitem", table(spark, sf_dir, "lineitem"), TableTests(expression=conditions))


@named("freshness")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of each source's newest enriched ride at the report's moment."""
    sources = [S.LIVE_SOURCE, S.BULK_SOURCE]
    return freshness(
        silver(spark, sf_dir), "_silver_processed_at", now(), **audit.FRESH_MINUTES, source="_source_system", sources=sources
    )


@query
def rate_card_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(audit.rate_card_audit(rides_table(spark, sf_dir), references(spark)))


# Measures ------------------------------------------------------------------------


@query
def kpi_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measure(fact(spark, sf_dir), now=now()))


@query
def kpi_by_vehicle_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = one_dimension(spark, "dim_vehicle_type")
    columns = {"vehicle_type_name": "vehicle_type_name", "tier_rank": "tier_rank"}
    rides = lookup(fact(spark, sf_dir), types, "vehicle_type_key", "vehicle_type_key", **columns)
    return rounded(measure(rides, by=["vehicle_type_name", "tier_rank"]))


@query
def kpi_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measure(fact(spark, sf_dir), by=["_source_system"], now=now()))


@query
def kpi_by_city_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two roles of the city dimension side by side."""
    city = one_dimension(spark, "dim_city")
    rides = lookup(fact(spark, sf_dir), city, "pickup_city_key", "city_key", pickup_city="city_name")
    rides = lookup(rides, city, "dropoff_city_key", "city_key", dropoff_city="city_name")
    names = ["total_rides", "total_revenue", "total_miles", "total_hours", "intercity_share"]
    return rounded(measure(rides, names, ["pickup_city", "dropoff_city"]))


@query
def rides_last_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = fact(spark, sf_dir)
    report = measure(rides, ["total_rides", "last_ride_received"], ["ride_status_key"], now())
    return with_rides_last_24_hours(report, rides, now())


@query
def revenue_mtd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(month_to_date(fact(spark, sf_dir), calendar(spark), F.sum("total_fare"), "revenue_mtd"))


@query
def revenue_mtd_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, by = F.sum("total_fare"), ["pickup_city_key"]
    return rounded(month_to_date(fact(spark, sf_dir), calendar(spark), amount, "revenue_mtd", by))


@query
def avg_fare_mtd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratio: fares and rides are added up over days, and divided last."""
    parts = {"fares": F.sum("total_fare"), "rides": F.count("total_fare")}
    amount = parts, F.try_divide("fares", "rides")
    return rounded(month_to_date(fact(spark, sf_dir), calendar(spark), amount, "avg_fare_mtd"))


@query
def revenue_mom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(month_over_month(fact(spark, sf_dir), calendar(spark), F.sum("total_fare")))


@query
def revenue_mom_by_vehicle_make(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount, by = F.sum("total_fare"), ["vehicle_make_key"]
    return rounded(month_over_month(fact(spark, sf_dir), calendar(spark), amount, by))


@query
def revenue_same_day_prior_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.sum("total_fare")
    return rounded(same_day_prior_month(fact(spark, sf_dir), calendar(spark), amount, "prior_revenue"))


@query
def rides_rolling_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_days(fact(spark, sf_dir), calendar(spark), ride_count(), 7, "rides_7d")


@query
def rides_rolling_7d_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides, by = fact(spark, sf_dir), ["_source_system"]
    return rolling_days(rides, calendar(spark), ride_count(), 7, "rides_7d", by)


# Incremental fact ----------------------------------------------------------------


def fact_table(spark: SparkSession, purpose: str) -> KeyedTable:
    return KeyedTable(scratch(spark, purpose), "ride_id", "date_key", ("_silver_processed_at",))


def corrected(rides: DataFrame) -> DataFrame:
    """A later delivery of each seventh ride: completed now, a day later, one unit dearer."""
    again = rides.where(ride_number() % 7 == 0)
    return again.withColumns(
        {
            "total_fare": F.col("total_fare") + 1,
            "pickup_timestamp": F.expr("pickup_timestamp + interval 1 day"),
            "date_key": F.date_add("date_key", 1),
            "ride_status_key": F.lit(1),
            "_silver_processed_at": F.expr("_silver_processed_at + interval 2 day"),
        }
    )


def loaded_twice(
    spark: SparkSession, sf_dir: str, purpose: str, keep: list[str] | None = None
) -> tuple[DataFrame | None, DataFrame]:
    """The table after a first load up to a moment, and after one increment of later rides and corrections.

    The increment rewrites the first state, of which the columns ``keep`` are stored before.
    """
    rides = stored(fact(spark, sf_dir), f"{purpose}-source")
    target = fact_table(spark, purpose)
    target.merge(rides.where(F.col("_silver_processed_at") <= F.lit(LOADED_UNTIL).cast("timestamp")))
    first = stored(target.read(spark).select(*keep), f"{purpose}-first") if keep else None
    source = rides.unionByName(corrected(rides))
    target.merge(newer_than(source, target.read(spark), "_silver_processed_at"))
    return first, target.read(spark)


@query
def look_back_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = stage_rides(silver(spark, sf_dir))
    loaded = rides.where(F.col("_silver_processed_at") <= F.lit(LOADED_UNTIL).cast("timestamp"))
    fresh = newer_than(rides, loaded, "_silver_processed_at")
    return rounded(
        fresh.groupBy("_source_system").agg(
            F.count(F.lit(1)).alias("rides"),
            F.min("_silver_processed_at").alias("oldest"),
            F.sum("total_fare").alias("revenue"),
        )
    )


@query
def fct_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, merged = loaded_twice(spark, sf_dir, "fct-upsert")
    columns = ["ride_id", "date_key", "ride_status_key", "total_fare", "_silver_processed_at"]
    return rounded(merged.select(*columns), 2)


@query
def fct_upsert_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that holds keys twice with one stamp, and is merged again in another order."""
    columns = ["ride_id", "date_key", "ride_status_key", "total_fare", "_silver_processed_at"]
    rides = stored(fact(spark, sf_dir).select(*columns), "fct-upsert-ties-source")
    again = rides.where(ride_number() % 4 == 0).withColumn("total_fare", F.col("total_fare") + ride_number() % 3 - 1)
    target = fact_table(spark, "fct-upsert-ties")
    merges = [rides.unionByName(again), again.unionByName(rides).orderBy("total_fare")]
    # The second one finds every row as it is, so the table's version stays the first.
    version = sum(target.merge(batch) > 0 for batch in merges)
    return rounded(target.read(spark).withColumn("version", F.lit(version)), 2)


@query
def schema_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge whose batch brings a new column and lacks one of the target's."""
    columns = ["ride_id", "date_key", "total_fare", "fare_band", "_silver_processed_at"]
    rides = stored(fact(spark, sf_dir).select(*columns), "schema-append-source")
    target = fact_table(spark, "schema-append")
    target.merge(rides)
    promoted = rides.where(ride_number() % 5 == 0).withColumn("promo_code", F.concat(F.lit("P"), ride_number() % 3))
    target.merge(promoted.drop("fare_band"))
    return target.read(spark).drop("_silver_processed_at")


@query
def table_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["ride_id", "date_key", "ride_status_key", "total_fare"]
    first, second = loaded_twice(spark, sf_dir, "table-changes", keep=columns)
    return rounded(row_changes(first, second.select(*columns), "ride_id"), 2)


# Files and streams ---------------------------------------------------------------


@query
def rescued_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk lines with mistyped fields, unknown fields and broken records."""
    ride, k = F.col("ride_id"), F.col("k")
    rides = rides_table(spark, sf_dir).select("ride_id", ride_number().alias("k"))
    good = F.format_string('{"ride_id":"%s","rating":%d,"is_test":false}', ride, k % 5 + 1)
    line = (
        F.when(k % 11 == 0, F.format_string('{"ride_id":"%s","rating":"five"}', ride))
        .when(k % 13 == 0, F.format_string('{"ride_id":"%s","rating":4,"promo":"X%d"}', ride, k % 3))
        .when(k % 17 == 0, F.format_string('{"ride_id":"%s", broken', ride))
        .when(k % 19 == 0, F.concat(F.lit("["), good, F.lit(","), good, F.lit("]")))
        .otherwise(good)
    )
    schema = spark.createDataFrame([], "ride_id string, rating int, is_test boolean").schema
    return parse(rides.select(line.alias("value"), "k"), schema, k)


def topic_files(spark: SparkSession, rides: DataFrame, root: str) -> DataFrame:
    """The live rides' topic, as a stream over files of Kafka-shaped records."""
    kafka_records(rides).write.parquet(f"{root}/topic")
    return spark.readStream.schema(S.KAFKA_RECORD_DDL).parquet(f"{root}/topic")


def stage_live(spark: SparkSession, rides: DataFrame, root: str) -> None:
    """The live rides through topic, bronze and staging; the topic goes when bronze has it."""
    flows.start_bronze_rides(topic_files(spark, rides, root), root).awaitTermination()
    remove(spark, f"{root}/topic")
    cores = spark.sparkContext.defaultParallelism
    flows.start_live_staging(spark, root, state_partitions=cores).awaitTermination()


def stage_bulk(spark: SparkSession, root: str, folder: str) -> None:
    bulk = flows.FileTable(f"{root}/bronze/bulk_rides", folder)
    bulk.start(spark).awaitTermination()
    flows.start_bulk_staging(bulk, spark, root).awaitTermination()


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "stream-dedup")
    stage_live(spark, rides_table(spark, sf_dir), root)
    return flows.staging_table(root).read(spark).drop("_ingested_at")


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "stream-bronze")
    flows.start_bronze_rides(topic_files(spark, rides_table(spark, sf_dir), root), root).awaitTermination()
    landed = flows.bronze_rides_table(root).read(spark)
    return landed.groupBy("kafka_topic", "kafka_partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
        F.max("kafka_enqueued_at").alias("last_enqueued_at"),
        F.count_if(F.col("ride_payload").startswith("{bad")).alias("unreadable"),
        F.max("kafka_key").alias("last_key"),
        F.count_if(F.col("_batch_id").isNull()).alias("unmarked"),
    )


@query
def stream_constraint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the live staging flow reports of each constraint, from its recorded metrics."""
    root = scratch(spark, "stream-constraint-counts")
    rides = flawed(rides_table(spark, sf_dir))
    booked = F.coalesce("booking_timestamp", "pickup_timestamp")
    kafka_records(rides.withColumn("booking_timestamp", booked)).write.parquet(f"{root}/topic")
    topic = spark.readStream.schema(S.KAFKA_RECORD_DDL).parquet(f"{root}/topic")
    flows.start_bronze_rides(topic, root).awaitTermination()
    with FlowMetrics(spark, root):
        flows.start_live_staging(spark, root).awaitTermination()
    return flow_totals(spark, root).drop("query")


@query
def append_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "append-flows")
    rides = rides_table(spark, sf_dir)
    bulk_lines(rides).select("value").write.text(f"{root}/raw")
    stage_live(spark, rides, root)
    stage_bulk(spark, root, f"{root}/raw")
    return flows.staging_table(root).read(spark).drop("_ingested_at")


@query
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "stream-static-join")
    stage_live(spark, rides_table(spark, sf_dir), root)
    flows.start_enrich(spark, root, flows.LIVE, lambda: references(spark)).awaitTermination()
    rows = flows.enriched_table(spark, root).read(spark)
    return rows.drop("_ingested_at", "_silver_processed_at")


@query
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk files whose later ones carry a new field: old rows read as null there."""
    root = scratch(spark, "schema-evolution")
    rides = rides_table(spark, sf_dir).select(
        "ride_id", "total_fare", "duration_minutes", ride_number().alias("k")
    )
    plain = rides.where("k % 3 <> 0").drop("k")
    promoted = rides.where("k % 3 = 0").withColumn("promo_code", F.concat(F.lit("P"), F.col("k") % 7)).drop("k")
    folder = f"{root}/raw"
    trips = flows.FileTable(f"{root}/bronze/trips", folder)
    for part in (plain, promoted):
        part.write.mode("append").json(folder)
        trips.start(spark).awaitTermination()
    stored = trips.read(spark)
    return stored.select("ride_id", "total_fare", "duration_minutes", "promo_code", "_rescued_data")


def reference_files(spark: SparkSession, root: str) -> None:
    """The six reference files at the producer's side."""
    for name, ref in S.REFERENCES.items():
        spark.sql(reference_sql(name)).coalesce(1).write.json(f"{root}/files/{ref.source}.json")


@query
def landing_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings: all files, the same again, and again after one file has changed.

    A bronze stream follows the raw zone, so each file's rows arrive once for each content.
    """
    root = scratch(spark, "landing-again")
    number = F.concat(F.lit("rides_"), F.col("k") % 3, F.lit(".json"))
    # A ride's text is many times its order, so rides are derived again for each file, not stored.
    days = bulk_lines(silver_rides(spark, sf_dir)).withColumn("file", number)
    names = [f"rides_{n}.json" for n in range(3)]
    entries = spark.createDataFrame([("bulk_rides", name) for name in names], "folder_name string, file_name string")

    def produce(rows: DataFrame, name: str) -> None:
        write_lines(rows.where(F.col("file") == name).select("value"), f"{root}/files/{name}")

    trips = flows.FileTable(f"{root}/bronze/bulk_rides", landed_folder(f"{root}/raw", "bulk_rides"))
    with no_shuffles_left(spark):
        for name in names:
            produce(days, name)
        for landing in range(3):
            if landing == 2:
                corrected_file = days.withColumn("value", F.regexp_replace("value", '"vehicle_color":"Black"', '"vehicle_color":"Blue"'))
                produce(corrected_file, names[1])
            land(spark, entries, f"{root}/files", f"{root}/raw")
            trips.start(spark).awaitTermination()
    file = F.regexp_extract("_source_file", "file_name=([^/]*)", 1).alias("file_name")
    return trips.read(spark).groupBy(file, "vehicle_color").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("ride_id").alias("rides")
    )


def land_all(spark: SparkSession, rides: DataFrame, root: str) -> str:
    """Write source files and their manifest, and land everything the manifest lists."""
    reference_files(spark, root)
    write_lines(bulk_lines(rides).select("value"), f"{root}/files/bulk_rides.json")
    # Two of the manifest's folder names end in a dot.
    dotted = {"map_cities", "map_cancellation_reasons"}
    entries = [(name + "." * (name in dotted), f"{name}.json") for name in S.FILE_TABLES]
    spark.createDataFrame(entries, "folder_name string, file_name string").coalesce(1).write.json(f"{root}/manifest")
    land(spark, read_manifest(spark, f"{root}/manifest"), f"{root}/files", f"{root}/raw")
    return f"{root}/raw"


@query
def manifest_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = land_all(spark, rides_table(spark, sf_dir), scratch(spark, "manifest-landing"))
    lines = spark.read.text(raw)
    return lines.groupBy("folder_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("value").contains('"ride_id"')).alias("rides"),
    )


@query
def end_to_end_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing, bronze, silver, gold and measures, each hop through its stored table.

    The producer's files and topic go when they have been landed and read; the tables stay.
    """
    root = scratch(spark, "end-to-end")
    rides = silver_rides(spark, sf_dir)
    with no_shuffles_left(spark):
        raw = land_all(spark, rides, root)
        remove(spark, f"{root}/files")
        stage_live(spark, rides, root)
        stage_bulk(spark, root, landed_folder(raw, "bulk_rides"))

        tables = flows.file_tables(raw, root, landed_folder)
        bronze = {}
        for ref in S.REFERENCES.values():
            tables[ref.source].start(spark).awaitTermination()
            bronze[ref.source] = tables[ref.source].read(spark)
        for name, ref in reference_tables(bronze).items():
            rebuild(ref, f"{root}/silver/{name}")

        def refs() -> dict[str, DataFrame]:
            return {name: spark.read.parquet(f"{root}/silver/{name}") for name in S.REFERENCES}

        for flow in (flows.LIVE, flows.BULK):
            flows.start_enrich(spark, root, flow, refs).awaitTermination()
        flows.build_gold(spark, root, refs, today())
    gold = flows.gold_tables(spark, root)
    # The stored dimension decides: a ride whose key it lacks would not be counted.
    known = gold["fct_rides"].join(gold["dim_vehicle_type"].select("vehicle_type_key"), "vehicle_type_key", "left_semi")
    names = ["total_rides", "completed_rides", "cancelled_rides", "total_revenue", "avg_fare", "rated_rides"]
    return rounded(measure(known, names, ["_source_system", "vehicle_type_key"]))
