"""Severity levels: classification, rank, and what is drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from isodose import schemas as S


def level_of(cpm: Column, threshold: Column | float) -> Column:
    """Level relative to an alert threshold: one, two and three times the threshold."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (
        F.when(cpm >= limit * 3, "high")
        .when(cpm >= limit * 2, "elevated")
        .when(cpm >= limit, "warning")
        .otherwise("safe")
    )


def level_band(cpm: Column, cuts: Sequence[float] = S.FIXED_CUTS) -> Column:
    """Level by three fixed lower bounds."""
    warning, elevated, high = cuts
    return (
        F.when(cpm >= high, "high")
        .when(cpm >= elevated, "elevated")
        .when(cpm >= warning, "warning")
        .otherwise("safe")
    )


def level_rank(level: Column) -> Column:
    """0 safe .. 3 high; null for an unknown level."""
    rank = F.lit(None).cast("int")
    for position, name in enumerate(S.LEVELS):
        rank = F.when(level == name, position).otherwise(rank)
    return rank


def level_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in S.LEVELS]), rank + 1)


def heat_intensity(level: Column) -> Column:
    """Weight of a cell on the heat map; unknown levels count as safe."""
    weight = F.lit(S.HEAT_INTENSITY["safe"])
    for name, value in S.HEAT_INTENSITY.items():
        weight = F.when(level == name, F.lit(value)).otherwise(weight)
    return weight


def marker_radius(cpm: Column) -> Column:
    return F.lit(4.0) + F.least(F.lit(8.0), cpm / 60)
