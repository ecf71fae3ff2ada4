"""Silver reference tables: the newest version of each key, typed and checked."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.operators.expectations import enforce
from fareline.operators.versions import count_occurrences, first_per_key


def current_reference(
    bronze: DataFrame, ref: S.Reference, processed_at: Column | None = None
) -> DataFrame:
    """Newest row per key by file time, cast as declared, with its key count after the cast.

    Keys are compared uncast, so the count can exceed one if the cast merges them.
    """
    columns = ref.types
    # Equal times are settled by file name, then by content: the same row on every run.
    newest = [
        F.col("_source_modified_at").desc(),
        F.col("_ingested_at").desc(),
        F.col("_source_file").desc(),
        F.struct(*columns).desc(),
    ]
    versions = bronze.select(*columns, "_source_file", "_source_modified_at", "_ingested_at")
    cast = first_per_key(versions, [ref.key], newest).select(
        *[F.col(name).try_cast(kind).alias(name) for name, kind in columns.items()],
        "_source_file",
        F.col("_ingested_at").alias("_bronze_ingested_at"),
    )
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return count_occurrences(cast, ref.key).withColumn("_silver_processed_at", stamp)


def checked_reference(bronze: DataFrame, ref: S.Reference) -> DataFrame:
    """The same, stopping the job on a null or repeated key: it would fan out every join."""
    return enforce(current_reference(bronze, ref), S.reference_rules(ref.key))


def reference_tables(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All reference tables from the bronze tables, by silver name."""
    return {name: checked_reference(bronze[ref.source], ref) for name, ref in S.REFERENCES.items()}
