"""Points within a distance of each other, by cells of that size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import EARTH_M, distance_m


def near_points(left: DataFrame, right: DataFrame, metres: float, left_at: tuple[str, str], right_at: tuple[str, str], on: list[str] = [], out: str = "distance_m") -> DataFrame:  # noqa: B006
    """Pairs of ``left`` and ``right`` (no common columns but ``on``) less than ``metres`` apart and equal in ``on``.

    Bands of latitude are as high as the distance; each is cut into cells at
    least as wide where it is narrowest.  A right point is in one cell; a left
    point goes to the cells of its own and the two next bands that its circle
    can touch, so no pair is missed, at the date line and the poles neither.
    Points without coordinates have no pairs.
    """
    reach = metres / EARTH_M
    if not 0 < reach < math.pi:
        raise ValueError("the distance must be more than nothing and less than half the globe")
    high = math.degrees(reach) * 1.000001
    narrow = lambda band: F.least(F.greatest(F.abs(band * high), F.abs((band + 1) * high)), F.lit(90.0))
    cells = lambda band: F.greatest(F.lit(1), F.floor(360 / high * F.cos(F.radians(narrow(band)))).cast("int"))
    band_of = lambda lat: F.floor(F.col(lat) / high).cast("int")

    lat, lon = right_at
    there = right.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("_band", band_of(lat))
    there = there.withColumn("_cell", F.pmod(F.floor((F.col(lon) + 180) / 360 * cells(F.col("_band"))).cast("int"), cells(F.col("_band"))))

    lat, lon = left_at
    here = left.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("_band", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: band_of(lat) + d)))
    n = cells(F.col("_band"))
    ratio = F.lit(math.sin(min(reach, math.pi / 2))) / F.cos(F.radians(F.col(lat)))
    # half the circle's width in degrees; a circle that holds a pole has all longitudes
    width = F.when(F.abs(F.col(lat)) + high >= 90, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * 1.000001)
    low, top = (F.floor((F.col(lon) + 180 + s * width) / 360 * n).cast("int") for s in (-1, 1))
    own = F.array_distinct(F.transform(F.sequence(low, F.least(top, low + n - 1)), lambda c: F.pmod(c, n)))
    here = here.withColumn("_cell", F.explode(own))
    met = here.join(there.hint("merge"), [*on, "_band", "_cell"]).withColumn(out, distance_m(*left_at, *right_at))
    return met.filter(F.col(out) < metres).drop("_band", "_cell")
