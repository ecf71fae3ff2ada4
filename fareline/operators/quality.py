"""Declarative table tests. A test reports how many rows or keys fail it.

Unlike expectations, a comparison with null passes here; only ``not_null`` looks
for nulls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ENTRIES = "array<struct<n:int,key:string>>"


@dataclass(frozen=True)
class TableTests:
    """The tests of one table."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    # column -> (parent table, parent key)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    accepted_values: Mapping[str, Sequence] = field(default_factory=dict)
    # column -> (low, high), both inclusive, either None for open
    accepted_range: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    # name of the column tested -> condition that must hold
    expression: Mapping[str, str] = field(default_factory=dict)


def out_of_range(value: Column, low: float | None, high: float | None) -> Column:
    below = F.lit(False) if low is None else value < low
    above = F.lit(False) if high is None else value > high
    return below | above


def row_checks(tests: TableTests) -> list[tuple[str, str, Column]]:
    """Tests that look at one row at a time, as (test, column, failing condition)."""
    checks = [("not_null", c, F.col(c).isNull()) for c in tests.not_null]
    checks += [
        ("accepted_values", c, ~F.col(c).isin(list(values)))
        for c, values in tests.accepted_values.items()
    ]
    checks += [
        ("accepted_range", c, out_of_range(F.col(c), low, high))
        for c, (low, high) in tests.accepted_range.items()
    ]
    checks += [("expression", c, ~F.expr(condition)) for c, condition in tests.expression.items()]
    return checks


def check_rows(name: str, df: DataFrame, tests: TableTests) -> DataFrame:
    """All row-at-a-time tests of a table in one scan."""
    checks = row_checks(tests)
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
    lines = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(test).alias("test"),
            F.lit(column).alias("column_name"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, (test, column, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*lines)))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys on more than one row; nulls are left to ``not_null``."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where("rows > 1")


def _entry(n: int, key: Column) -> Column:
    return F.struct(F.lit(n).alias("n"), key.alias("key"))


def _entries(df: DataFrame, tests: TableTests, first: int) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(n, key) of a table from one scan, and its tests as (test, column), numbered from ``first``.

    A row gives an entry for each of its keys. Only a row that fails some check gives
    entries for those, so a clean row costs no more than its keys.
    """
    checks = row_checks(tests)
    keyed = [*(("unique", c) for c in tests.unique), *(("relationships", c) for c in tests.relationships)]
    keys = [_entry(first + len(checks) + i, F.col(c).cast("string")) for i, (_, c) in enumerate(keyed)]
    parts = [F.array(*[F.when(key["key"].isNotNull(), key) for key in keys])] if keys else []
    if checks:
        some = reduce(Column.__or__, [F.coalesce(bad, F.lit(False)) for _, _, bad in checks])
        failed = F.array(*[F.when(bad, _entry(first + i, F.lit(""))) for i, (_, _, bad) in enumerate(checks)])
        parts.append(F.when(some, failed).otherwise(F.array().cast(ENTRIES)))
    listed = [(test, column) for test, column, _ in checks] + keyed
    parts = parts or [F.array().cast(ENTRIES)]
    return df.select(F.inline(F.concat(*parts))).where("n is not null"), listed


def run_tests(tables: Mapping[str, DataFrame], suite: Mapping[str, TableTests]) -> DataFrame:
    """The report of a whole suite: one row per test.

    Each table is read once and gives entries of a test and a key. Those of all tables are
    counted together, map-side first, so a hot key or a failing check is a row per task in
    the one shuffle; then keys of unique columns fail where they count more than one row,
    and keys of a relationship where their parent lacks them.
    """
    entries, parents, lines = [], [], []
    for name, tests in suite.items():
        found, listed = _entries(tables[name], tests, len(lines))
        entries.append(found)
        for test, column in listed:
            if test == "relationships":
                parent, key = tests.relationships[column]
                parents.append(tables[parent].select(F.lit(len(lines)).alias("n"), F.col(key).cast("string").alias("key")))
            lines.append((len(lines), name, test, column))
    counted = reduce(DataFrame.unionByName, entries).groupBy("n", "key").agg(F.count(F.lit(1)).alias("rows"))
    if parents:
        known = reduce(DataFrame.unionByName, parents).distinct().withColumn("known", F.lit(True))
        counted = counted.join(known, ["n", "key"], "left")
    else:
        counted = counted.withColumn("known", F.lit(None).cast("boolean"))
    unique = [n for n, _, test, _ in lines if test == "unique"]
    failing = F.when(F.col("n").isin(unique), (F.col("rows") > 1).cast("bigint")).when(F.col("known"), 0).otherwise(F.col("rows"))
    failures = counted.groupBy("n").agg(F.sum(failing).alias("failures"))
    spark = next(iter(tables.values())).sparkSession
    named = spark.createDataFrame(lines, "n int, table_name string, test string, column_name string")
    return named.join(failures, "n", "left").select(
        "table_name", "test", "column_name", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")
    )


class SuiteFailed(Exception):
    """Table tests that found failures, as (table, test, column, failures)."""


def require_passing(report: DataFrame) -> DataFrame:
    """The report, unless a test in it failed: then the run stops. One row per test is collected."""
    failed = report.where("failures > 0").orderBy("table_name", "test", "column_name").collect()
    if failed:
        raise SuiteFailed([tuple(row) for row in failed])
    return report


def freshness(
    df: DataFrame,
    loaded_at: str,
    now: Column,
    warn_minutes: int,
    error_minutes: int,
    source: str | None = None,
    sources: Sequence[str] = (),
) -> DataFrame:
    """How old the newest row is, and whether that passes, warns or fails.

    With ``source``, a column, for each of the ``sources`` apart, from the same scan; one
    without rows fails.
    """
    seconds = F.unix_timestamp(now) - F.unix_timestamp("last_loaded_at")
    status = (
        F.when(F.col("last_loaded_at").isNull() | (seconds > error_minutes * 60), "error")
        .when(seconds > warn_minutes * 60, "warn")
        .otherwise("pass")
    )
    newest = F.max(loaded_at).alias("last_loaded_at")
    if source is None:
        found, kept = df.agg(newest), []
    else:
        expected = df.sparkSession.createDataFrame([(s,) for s in sources], f"`{source}` string")
        found, kept = expected.join(df.groupBy(source).agg(newest), source, "left"), [source]
    return found.select(*kept, "last_loaded_at", seconds.alias("age_seconds"), status.alias("status"))
