"""Newest row per key, and how often a key occurs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark turns the ``= 1`` filter into a group limit that also runs before the
    shuffle, so a task sends at most one row per key however hot the key is.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def count_occurrences(df: DataFrame, key: str, name: str = "_key_occurrences") -> DataFrame:
    """Append how many rows share this row's key, nulls counting as one key.

    The counts are pre-aggregated and only repeated keys are joined back, so a key
    that fills a third of the table is never gathered in one task.
    """
    repeated = (
        df.groupBy(F.col(key).alias("_repeated")).agg(F.count(F.lit(1)).alias(name))
    ).where(F.col(name) > 1)
    joined = df.join(repeated, F.col(key).eqNullSafe(F.col("_repeated")), "left")
    return joined.select(*df.columns, F.coalesce(F.col(name), F.lit(1).cast("bigint")).alias(name))
