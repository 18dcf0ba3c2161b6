"""Dispatch, preparation and supply formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dispatch_score(distance_km: Column, rating: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.lit(10.0) - distance_km) + rating, 2)


def planned_distance_km(
    partner_to_pickup: Column, pickup_to_drop: Column, partner_to_drop: Column, is_batched: Column
) -> Column:
    """A batched order is planned from the partner straight to its drop; zero means unknown."""
    km = F.when(is_batched, partner_to_drop).otherwise(partner_to_pickup + pickup_to_drop)
    return F.nullif(F.round(km, 3), F.lit(0.0))


def queue_prep_minutes(prep_minutes: Column, backlog: Column, slowdown: float = 0.08) -> Column:
    return prep_minutes * (F.lit(1.0) + F.lit(slowdown) * F.greatest(F.lit(0), backlog - 1))


def eta_minutes(prep_minutes: Column, distance_km: Column, km_per_minute: float, buffer_minutes: float) -> Column:
    return prep_minutes + distance_km / F.lit(km_per_minute) + F.lit(buffer_minutes)


def restaurant_weight(rating: Column, backlog: Column) -> Column:
    return F.greatest(F.lit(0.05), rating - F.lit(0.5) * backlog)


def is_over_capacity(backlog: Column, capacity: Column) -> Column:
    return backlog >= capacity


def supply_target(partners: Column, ratio: Column) -> Column:
    """Partners that should be online; halves round to the even number."""
    return F.bround(partners * ratio, 0).cast("long")
