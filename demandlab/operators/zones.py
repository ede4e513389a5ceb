"""Matching points to delivery zones by an equi-join on the cells of their covers.

A zone starts on the grid level of its own size: its cells are as wide as the next
power of two, so its bounding box touches at most two of them each way, however
large or small other zones are. Cells crossed by many edges are split (see
``cell_cover``), so a zone of any outline is a list of cells with few edges each,
and cells wholly inside carry none. A point falls into one cell of each level that
its site uses, so the candidates come from one join on (site, level, cell), and
only the edges that cross the point's own cell are tested.

Every zone row is met once by a point near it. A point inside two zones, or
inside two equal rows of one zone, yields two rows; a zone stored in parts yields
one for the part that holds the point. A zone with a vertex without coordinates
holds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.functions import geometry
from demandlab.functions.cell_cover import cell_of, cover, depth, inside_cell
from demandlab.sources.tables import Tables

# Zones smaller than this share a level.
SMALLEST_CELL = 1e-6


def zone_shapes(tables: Tables, groups: DataFrame | None = None) -> DataFrame:
    """Zones of each site with edges and bounding box; only those of the groups if given."""
    zones = tables.microzone
    if groups is not None:
        chosen = tables.microzone_group.join(groups, "microzone_group_code", "left_semi")
        zones = zones.join(chosen, "microzone_id", "left_semi")
    x_min, x_max = geometry.extent(F.col("boundaries"), "x")
    y_min, y_max = geometry.extent(F.col("boundaries"), "y")
    return zones.select(
        "site_id",
        "microzone_id",
        geometry.edges(F.col("boundaries")).alias("edges"),
        x_min.alias("x_min"),
        x_max.alias("x_max"),
        y_min.alias("y_min"),
        y_max.alias("y_max"),
    )


def _level() -> Column:
    """The power of two of a zone's cell side: the smallest that is no less than its longer side."""
    longer = F.greatest(F.col("x_max") - F.col("x_min"), F.col("y_max") - F.col("y_min"), F.lit(SMALLEST_CELL))
    return F.ceil(F.log2(longer)).cast("int")


def _placed(shapes: DataFrame) -> DataFrame:
    """Shapes that can hold a point, with the level of their size."""
    gap = F.exists("edges", lambda e: e["x1"].isNull() | e["y1"].isNull() | e["x2"].isNull() | e["y2"].isNull())
    outlined = F.col("x_min").isNotNull() & F.col("y_min").isNotNull() & ~gap
    return shapes.filter(outlined).withColumn("__level", _level())


def zone_cells(shapes: DataFrame) -> DataFrame:
    """The covers of all shapes: one row per cell that is not wholly outside its shape."""
    x_range, y_range = (tuple(F.col(f"{axis}_{end}") for end in ("min", "max")) for axis in "xy")
    cells = cover(F.col("edges"), F.col("__level"), x_range, y_range)
    return _placed(shapes).select("site_id", "microzone_id", F.inline(cells))


def match_zones(points: DataFrame, shapes: DataFrame) -> DataFrame:
    """Join points (site_id, latitude, longitude, ...) to the zones around them, adding microzone_id."""
    x, y = F.col("latitude"), F.col("longitude")
    keys = {"level": "__level", "cx": "__cx", "cy": "__cy"}
    tests = {"edges": "__edges", "odd": "__odd", "turns": "__turns"}
    cells = zone_cells(shapes).withColumnsRenamed({**keys, **tests})
    # One row per site with its levels: a level doubles the last, so there are few.
    used = F.sequence(F.col("__level") - depth(F.col("edges")), F.col("__level"))
    levels = (
        _placed(shapes)
        .select("site_id", F.explode(used).alias("__level"))
        .groupBy("site_id")
        .agg(F.collect_set("__level").alias("__levels"))
    )
    return (
        points.join(levels, "site_id")
        .withColumn("__level", F.explode("__levels"))
        .withColumns({"__cx": cell_of(x, F.col("__level")), "__cy": cell_of(y, F.col("__level"))})
        .drop("__levels")
        .join(cells, ["site_id", *keys.values()])
        .filter(inside_cell(F.col("__edges"), F.col("__odd"), F.col("__turns"), x, y))
        .drop(*keys.values(), *tests.values())
    )


def match_zone_groups(points: DataFrame, tables: Tables, groups: DataFrame | None = None) -> DataFrame:
    """Points (region_code, latitude, longitude, ...) with the group code of each zone around them.

    ``groups`` (microzone_group_code) leaves other groups and their zones out. The
    polygon test runs once per point and zone, however many datasets use it. The
    site is looked up for the points, so that the zone side of the join stays a
    plain table whose size the optimizer knows.
    """
    sites = tables.site.select("site_id", F.col("identifier_value").alias("region_code"))
    members = tables.microzone_group
    if groups is not None:
        members = members.join(groups, "microzone_group_code", "left_semi")
    placed = match_zones(points.join(sites, "region_code"), zone_shapes(tables, groups))
    return placed.join(members, "microzone_id").drop("site_id")
