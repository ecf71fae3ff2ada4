"""Silver rides: both sources brought to one typed shape. Valid for batch and stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.operators.expectations import enforce
from fareline.operators.versions import first_per_key


def typed(rides: DataFrame, source: str) -> DataFrame:
    """The silver columns. Text that is no timestamp or number becomes null, and so does
    a field the source never had."""
    present = set(rides.columns)

    def column(name: str, kind: str) -> Column:
        if name not in present:
            return F.lit(None).cast(kind)
        if name in S.RIDE_TIMES:
            return F.try_to_timestamp(F.col(name).cast("string"))
        return F.col(name).try_cast(kind)

    fields = {n: k for n, k in S.SILVER_RIDE_TYPES.items() if n in S.RIDE_TYPES}
    return rides.select(
        *[column(name, kind).alias(name) for name, kind in fields.items()],
        F.lit(source).alias("_source_system"),
        "_ingested_at",
    )


def parsed(bronze: DataFrame) -> DataFrame:
    """The payload's fields, the enqueue time, and nothing else.

    The declared schema is the contract: bad JSON gives null fields, a mistyped field
    a null.
    """
    ride = F.from_json("ride_payload", S.RIDE_DDL).alias("ride")
    return bronze.select(ride, "kafka_enqueued_at", "_ingested_at").select(
        "ride.*", "kafka_enqueued_at", "_ingested_at"
    )


def thin_repeats(rides: DataFrame, key: str = "ride_id") -> DataFrame:
    """Drop repeats of a key within one Arrow batch, before any shuffle.

    Optional combiner for a stream in which one key floods its partition: the dedup
    after it keeps one row per key of a micro-batch anyway, so its result stays valid.
    """

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table({"key": batch.column(key), "row": pa.array(np.arange(batch.num_rows))})
            named = table.filter(table["key"].is_valid()).group_by("key").aggregate([("row", "min")])
            unnamed = table.filter(table["key"].is_null())["row"]
            rows = pa.chunked_array([*named["row_min"].chunks, *unnamed.chunks], pa.int64())
            yield batch.take(rows.combine_chunks())

    return rides.mapInArrow(first_rows, rides.schema)


def live_rides(bronze: DataFrame, combine: bool = False, arrived: str | None = None) -> DataFrame:
    """Rides of the event stream, one per ``ride_id`` within the dedup horizon.

    Rows without an id can never pass the drop rule after the dedup. They leave before
    it, or they would all meet in one state entry of one task. With ``arrived``, rows and
    violations of that rule are counted under this name before they leave.
    """
    rides = parsed(bronze)
    if arrived:
        unnamed = F.count_if(F.col("ride_id").isNull()).alias("valid_ride_id")
        rides = rides.observe(arrived, F.count(F.lit(1)).alias("rows"), unnamed)
    if combine:
        rides = thin_repeats(rides)
    if rides.isStreaming:
        horizon = rides.withWatermark("kafka_enqueued_at", S.DEDUP_HORIZON)
        unique = horizon.where("ride_id IS NOT NULL").dropDuplicatesWithinWatermark(["ride_id"])
    else:
        arrival = [F.col("kafka_enqueued_at"), F.col("_ingested_at")]
        unique = first_per_key(rides.where("ride_id IS NOT NULL"), ["ride_id"], arrival)
    return typed(unique, S.LIVE_SOURCE)


def bulk_rides(bronze: DataFrame) -> DataFrame:
    """Rides of the historical files, as they are: no dedup, no watermark."""
    return typed(bronze, S.BULK_SOURCE)


def staged(rides: DataFrame, metrics: str | None = None) -> DataFrame:
    """Rides that meet the staging constraints."""
    return enforce(rides, S.STAGING_RULES, metrics)
