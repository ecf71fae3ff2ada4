"""Left equi-joins from a large table to key-unique lookup tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, table: DataFrame, on: str, key: str, **columns: str) -> DataFrame:
    """Append ``columns`` (new name = column of ``table``) found by ``facts.on = table.key``.

    No broadcast hint: Spark broadcasts the table while its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it, where adaptive
    execution splits a hot or null key over several tasks.
    """
    found = table.select(
        F.col(key).alias(on), *[F.col(old).alias(new) for new, old in columns.items()]
    )
    return facts.join(found, on, "left")


def counted_keys(child: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, key, rows): the keys that each column carries, as text, from one scan; no nulls."""
    carried = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("key")) for c in columns])
    keys = child.select(F.inline(carried)).where("key is not null")
    return keys.groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("rows"))


def known_keys(parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(column_name, key): the keys of each column's parent, as text."""
    stacked = [
        parent.select(F.lit(column).alias("column_name"), F.col(key).cast("string").alias("key"))
        for column, (parent, key) in parents.items()
    ]
    return reduce(DataFrame.unionByName, stacked)


def orphans(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(column_name, key, rows): keys of ``child`` with no row in their column's parent.

    ``parents`` maps a column to its parent table and the key there. Null keys are not
    orphans. All columns are read in one scan and counted before the one join, which
    leaves a row per distinct key to shuffle, however hot a key is. Keys compare as text.
    """
    return counted_keys(child, list(parents)).join(known_keys(parents), ["column_name", "key"], "left_anti")
