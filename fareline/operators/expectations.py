"""Row constraints with an action: warn counts, drop removes, fail stops the job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fareline.schemas import Rule


def holds(rule: Rule, null_passes: bool = False) -> Column:
    """True where the row meets the rule; a condition that is null counts as ``null_passes``."""
    return F.coalesce(F.expr(rule.condition), F.lit(null_passes))


def violations(rules: Sequence[Rule], null_passes: bool = False) -> list[Column]:
    return [F.count_if(~holds(rule, null_passes)).alias(rule.name) for rule in rules]


def enforce(
    df: DataFrame,
    rules: Sequence[Rule],
    metrics: str | Observation | None = None,
    null_passes: bool = False,
) -> DataFrame:
    """Apply the rules in one pass over batch or stream.

    With ``metrics``, violations are counted on the way through, before any row is
    dropped: a name reports them with each micro-batch's progress, an ``Observation``
    with a batch action.
    """
    if metrics is not None:
        df = df.observe(metrics, F.count(F.lit(1)).alias("rows"), *violations(rules, null_passes))
    for rule in rules:
        if rule.action == "fail":
            stop = F.raise_error(F.lit(f"constraint {rule.name} violated: {rule.condition}"))
            df = df.where(F.when(holds(rule, null_passes), True).otherwise(stop.cast("boolean")))
    # A filter drops nulls by itself, and a bare comparison can reach the file scan.
    keep = F.expr if not null_passes else lambda condition: F.coalesce(F.expr(condition), F.lit(True))
    kept = [keep(f"({rule.condition})") for rule in rules if rule.action == "drop"]
    return df.where(reduce(Column.__and__, kept)) if kept else df


def tally(df: DataFrame, rules: Sequence[Rule], null_passes: bool = False) -> DataFrame:
    """One row per rule with the rows that break it, from a single scan."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *violations(rules, null_passes))
    report = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("constraint"),
                F.lit(rule.action).alias("action"),
                F.col(rule.name).alias("violations"),
                (F.col("rows") - F.col(rule.name)).alias("passed"),
            )
            for rule in rules
        ]
    )
    return counts.select(F.inline(report))
