"""Incremental tables: look-back filter, merge on key, and the changes between two states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.operators.versions import first_per_key
from fareline.schemas import LOOK_BACK


def high_water(target: DataFrame, column: str) -> int:
    """Newest instant in the target in microseconds, one long before any ride if it is empty."""
    start = F.lit("1900-01-01").cast("timestamp")
    return target.agg(F.unix_micros(F.coalesce(F.max(column), start))).first()[0]


def look_back_bound(target: DataFrame, column: str, look_back: str = LOOK_BACK) -> Column:
    """The instant after which source rows are taken: the target's newest less a margin.

    It is computed first and returned as a literal, so that filters on it reach the scan.
    """
    newest = F.timestamp_micros(F.lit(high_water(target, column)))
    return newest - F.expr(f"interval {look_back}")


def newer_than(source: DataFrame, target: DataFrame, column: str, look_back: str = LOOK_BACK) -> DataFrame:
    """Source rows newer than the target's newest row less the margin."""
    return source.where(F.col(column) > look_back_bound(target, column, look_back))


def keep_newest(batch: DataFrame, key: str, newest: Sequence[Column]) -> DataFrame:
    return first_per_key(batch, [key], newest)


def append_columns(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bring both sides to one schema: the target's columns and types, then new ones of the batch."""
    have, comes = dict(target.dtypes), dict(batch.dtypes)
    names = [*have, *[name for name in comes if name not in have]]

    def shaped(df: DataFrame, own: dict[str, str]) -> DataFrame:
        return df.select(
            *[
                (F.col(name) if name in own else F.lit(None)).cast(have.get(name) or comes[name]).alias(name)
                for name in names
            ]
        )

    return shaped(target, have), shaped(batch, comes)


def changed_rows(target: DataFrame, batch: DataFrame, key: str, unset: Sequence[str] = ()) -> DataFrame:
    """Batch rows that are new or differ from the target's row of their key.

    Columns in ``unset`` are not compared. ``batch`` must hold one row per key.
    """
    old, new = append_columns(target, batch)
    compared = [c for c in new.columns if c not in unset]
    here, there = F.struct(*[F.col(f"new.{c}") for c in compared]), F.struct(*[F.col(f"old.{c}") for c in compared])
    same = (F.col(f"new.{key}") == F.col(f"old.{key}")) & here.eqNullSafe(there)
    return new.alias("new").join(old.alias("old"), same, "left_anti").select(*batch.columns)


def merge_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target after the merge: batch rows replace those with their key, the rest are added.

    ``batch`` must hold one row per key. Only the batch's keys take part in the join,
    so a small batch is broadcast and the target stays where it is.
    """
    target, batch = append_columns(target, batch)
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)


def merge_into(spark_table: str, batch: DataFrame, key: str) -> None:
    """The same merge inside a table format that supports row-level changes."""
    match = F.col(f"{spark_table}.{key}") == F.col(f"batch.{key}")
    (
        batch.alias("batch")
        .mergeInto(spark_table, match)
        .withSchemaEvolution()
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def table_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Row-level difference of two states: insert, delete, update_preimage, update_postimage."""
    old, new = append_columns(old, new)
    image = [F.struct(*[F.col(f"{side}.{name}") for name in old.columns]) for side in ("old", "new")]
    before, after = image
    is_old, is_new = F.col(f"old.{key}").isNotNull(), F.col(f"new.{key}").isNotNull()

    def change(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), row.alias("row"))

    changes = (
        F.when(~is_old, F.array(change("insert", after)))
        .when(~is_new, F.array(change("delete", before)))
        .otherwise(F.array(change("update_preimage", before), change("update_postimage", after)))
    )
    both = old.alias("old").join(new.alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    differing = both.where(~(is_old & is_new & before.eqNullSafe(after)))
    return differing.select(F.inline(changes)).select("row.*", "_change_type")
