"""Scores on the 0-100 scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def clip(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Inside [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def range_score(value: Column, low: Column, high: Column, polarity: Column) -> Column:
    """Position of a value between two bounds; a missing value counts as 0, an empty range scores 0."""
    share = clip((F.coalesce(value, F.lit(0.0)) - low) / F.nullif(high - low, F.lit(0.0)) * 100.0)
    flipped = F.when(polarity == "negative", 100.0 - share).otherwise(share)
    return F.when(high <= low, F.lit(0.0)).otherwise(flipped)


def weighted_mean(value: Column, weight: Column, empty: float | None = None) -> Column:
    """Aggregate: mean by weight over non-null values with a positive weight; ``empty`` when there are none."""
    usable = value.isNotNull() & (weight > 0)
    mean = F.sum(F.when(usable, value * weight)) / F.nullif(F.sum(F.when(usable, weight)), F.lit(0.0))
    return mean if empty is None else F.coalesce(mean, F.lit(empty))


def log_score(count: Column, low: float, high: float, at_max: float) -> Column:
    """Grows with the logarithm of a count from ``low`` (none) to ``high`` (``at_max`` or more)."""
    scaled = F.log1p(F.greatest(F.lit(0.0), count)) / F.log1p(F.lit(max(1.0, at_max)))
    return clip(F.lit(low) + F.lit(high - low) * scaled, low, high)


def capped_share(count: Column, cap: float) -> Column:
    """Share of a cap, at most 100; null stays null."""
    return F.when(count.isNotNull(), F.least(F.lit(100.0), count / F.lit(max(1.0, cap)) * 100.0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2.0)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
