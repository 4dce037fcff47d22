"""Areas of zones on the sphere, with built-in higher-order functions.

A ring is ``array<struct<lon:double, lat:double>>`` in degrees, closed (last point
equals the first); a polygon is an array of parts, a part an array of rings: its shell,
then its holes.  Edges are great-circle arcs on a perfect sphere, the model of the
warehouse dialect's area function, so the result is exact but for floating point (about
1e-9 of the area).  It runs per row on the JVM; no geometry library.

Each edge adds the spherical excess between itself and the equator,
``2 atan2(tan(dlon/2) (t1 + t2), 1 + t1 t2)`` with ``t = tan(lat/2)``.  A ring whose
longitudes go once round encloses a pole; what the edges sum up then is the rest of the
hemisphere.  Of the two sides of a ring the smaller one is meant.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sphere radius in metres and the m^2 -> km^2 factor of the report.
EARTH_RADIUS_M = 6371010.0
M2_PER_KM2 = 1000000


def _ring_steradians(ring: Column) -> Column:
    """The solid angle of a ring; 0 for fewer than three corners, null for a null ring."""
    def edge(i):
        p, q = F.get(ring, i), F.get(ring, i + F.lit(1))
        dlon = F.radians(q["lon"]) - F.radians(p["lon"])
        dlon = dlon - F.round(dlon / F.lit(2 * math.pi)) * F.lit(2 * math.pi)  # the short way, across 180 degrees too
        t1, t2 = F.tan(F.radians(p["lat"]) / F.lit(2.0)), F.tan(F.radians(q["lat"]) / F.lit(2.0))
        excess = F.lit(2.0) * F.atan2(F.tan(dlon / F.lit(2.0)) * (t1 + t2), F.lit(1.0) + t1 * t2)
        return F.struct(excess.alias("e"), dlon.alias("d"))

    zero = F.struct(F.lit(0.0).alias("e"), F.lit(0.0).alias("d"))
    edges = F.transform(F.sequence(F.lit(0), F.size(ring) - F.lit(2)), edge)
    sums = F.aggregate(edges, zero, lambda a, x: F.struct((a["e"] + x["e"]).alias("e"), (a["d"] + x["d"]).alias("d")), lambda a: F.when(
        F.abs(a["d"]) > F.lit(math.pi), F.lit(2 * math.pi) - F.abs(a["e"])).otherwise(F.abs(a["e"])))
    return F.when(ring.isNull(), None).when(F.size(ring) < F.lit(4), F.lit(0.0)).otherwise(
        F.least(sums, F.lit(4 * math.pi) - sums))


def ring_area_m2(ring: Column) -> Column:
    """Area inside a ring; null for fewer than three corners."""
    return F.when(F.size(ring) >= F.lit(4), _ring_steradians(ring) * F.lit(EARTH_RADIUS_M ** 2))


def ring_area_km2(ring: Column, digits: int = 1) -> Column:
    return F.round(ring_area_m2(ring) / F.lit(M2_PER_KM2), digits)


def polygon_area_m2(parts: Column) -> Column:
    """Area of a polygon: the sum of its parts' shells less their holes.  Parts do not
    overlap and holes lie inside their shells; a polygon without parts has area 0."""
    def part(rings):
        holes = F.when(F.size(rings) > F.lit(1), F.slice(rings, 2, F.greatest(F.size(rings) - F.lit(1), F.lit(0))))
        shell = F.coalesce(_ring_steradians(F.get(rings, F.lit(0))), F.lit(0.0))
        return shell - F.coalesce(F.aggregate(F.transform(holes, _ring_steradians), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))),
                                  F.lit(0.0))

    total = F.aggregate(F.transform(parts, part), F.lit(0.0), lambda a, x: a + x)
    return total * F.lit(EARTH_RADIUS_M ** 2)


def polygon_area_km2(parts: Column, digits: int = 1) -> Column:
    return F.round(polygon_area_m2(parts) / F.lit(M2_PER_KM2), digits)
