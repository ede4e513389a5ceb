"""Point-in-polygon as column expressions over rings of points.

A zone is an array of rings and a ring an array of ``struct<x, y>``; later rings
are holes. x is the latitude and y the longitude.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of one ring, closing the ring if it is left open."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))

    def upward(p: Column, q: Column) -> Column:
        low, high = F.when(p["y"] <= q["y"], p).otherwise(q), F.when(p["y"] <= q["y"], q).otherwise(p)
        return F.struct(
            low["x"].alias("x1"), low["y"].alias("y1"), high["x"].alias("x2"), high["y"].alias("y2")
        )

    return F.zip_with(ring, following, upward)


def edges(boundaries: Column) -> Column:
    """All edges of all rings as ``array<struct<x1, y1, x2, y2>>`` with y1 <= y2.

    Build this once per zone: one even-odd count over every ring together gives
    the same answer as testing the outer ring and then the holes.
    """
    return F.flatten(F.transform(boundaries, _ring_edges))


def extent(boundaries: Column, axis: str) -> tuple[Column, Column]:
    """Smallest and largest coordinate of a zone along ``axis`` ('x' or 'y')."""
    values = F.transform(F.flatten(boundaries), lambda p: p[axis])
    return F.array_min(values), F.array_max(values)


def side(e: Column, x: Column, y: Column) -> Column:
    """Positive where the edge lies at larger x than the point, 0 on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


# The cheap comparisons come first and settle most edges.
def crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether the ray from the point to larger x crosses the edge."""
    return (e["y1"] <= y) & (y < e["y2"]) & (side(e, x, y) > 0)


def touches(e: Column, x: Column, y: Column) -> Column:
    """Whether the point is on the edge."""
    within = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
    return (e["y1"] <= y) & (y <= e["y2"]) & (side(e, x, y) == 0) & within


def inside(zone_edges: Column, x: Column, y: Column) -> Column:
    """True when the point is strictly inside; points on an edge are outside."""
    odd = F.size(F.filter(zone_edges, lambda e: crosses(e, x, y))) % 2 == 1
    return odd & ~F.exists(zone_edges, lambda e: touches(e, x, y))


def contains(boundaries: Column, x: Column, y: Column) -> Column:
    """``inside`` straight from the rings, for a single test."""
    return inside(edges(boundaries), x, y)
