"""Category columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline import schemas as S


def band(value: Column, edges: Iterable[tuple[float, str]], top: str) -> Column:
    """The label of the first edge above ``value``; a null compares with none and gets ``top``."""
    chain = F
    for edge, label in edges:
        chain = chain.when(value < edge, label)
    return chain.otherwise(top)


def distance_band(miles: Column) -> Column:
    return band(miles, S.DISTANCE_EDGES, S.DISTANCE_TOP)


def fare_band(fare: Column) -> Column:
    known = band(fare, S.FARE_EDGES, S.FARE_TOP)
    return F.when(fare.isNotNull(), known).otherwise(S.FARE_MISSING)


def tier_rank(vehicle_type: Column) -> Column:
    """1 for the cheapest tier upwards; an unlisted or missing name ranks last."""
    position = F.array_position(F.array(*map(F.lit, S.TIERS)), vehicle_type).cast("int")
    return F.when(position > 0, position).otherwise(S.TIER_OTHER)
