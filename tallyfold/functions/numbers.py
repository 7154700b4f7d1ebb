"""Distances, reliabilities and costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import text

EARTH_M = 6_371_000


def distance_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres; null if a coordinate is."""
    a, b, c, d = (F.radians(text(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def reliability(confidence: Column | str) -> Column:
    """0..5 from a confidence of 0..1, half to even; 0 for what is no number."""
    stars = F.bround(text(confidence).try_cast("double") * 5, 0).cast("int")
    return F.when(stars.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.lit(5), stars)))  # least and greatest pass over nulls


def token_estimate(c: Column | str) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text(c)) / 4))


def cost(tokens_in: Column, tokens_out: Column, per_million_in: float, per_million_out: float) -> Column:
    return tokens_in * per_million_in / 1e6 + tokens_out * per_million_out / 1e6
