import math
import random

import pytest
from pyspark.sql import functions as F

from demandlab.functions.geometry import contains, edges, inside
from demandlab.operators.zones import _level, match_zone_groups, match_zones, zone_cells, zone_shapes
from demandlab.session import materialize
from demandlab.sources.tables import Tables

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]
TRIANGLE = [(3.0, 3.0), (9.0, 3.5), (5.0, 8.0)]


def as_points(rings):
    return [[{"x": x, "y": y} for x, y in ring] for ring in rings]


def hit(spark, rings, x, y):
    boundaries = F.array(*[F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in r]) for r in rings])
    return spark.range(1).select(contains(boundaries, F.lit(x), F.lit(y)).alias("v")).first().v


@pytest.mark.parametrize(("x", "y", "inside"), [(1.0, 1.0, True), (5.0, 1.0, False), (2.0, 3.0, True)])
def test_square(spark, x, y, inside):
    assert hit(spark, [SQUARE], x, y) is inside
    assert hit(spark, [SQUARE[::-1]], x, y) is inside
    assert hit(spark, [SQUARE + SQUARE[:1]], x, y) is inside  # closed ring


@pytest.mark.parametrize(("x", "y"), [(0.0, 0.0), (4.0, 2.0), (2.0, 0.0), (0.0, 3.0), (2.0, 4.0), (4.0, 4.0)])
def test_boundary_is_outside(spark, x, y):
    assert hit(spark, [SQUARE], x, y) is False


def test_hole_is_outside(spark):
    assert hit(spark, [SQUARE, HOLE], 1.5, 1.5) is False
    assert hit(spark, [SQUARE, HOLE], 0.5, 1.5) is True


def reference_inside(rings, x, y):
    """Plain winding of a horizontal ray, for points that are on no edge."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def test_grid_join_equals_testing_every_pair(make_tables, rows_of, spark):
    zones = {1: (1, [SQUARE, HOLE]), 2: (1, [TRIANGLE]), 3: (2, [TRIANGLE]), 4: (1, [[(-50.0, -60.0), (70.0, -60.0), (8.0, 90.0)]])}
    tables = make_tables(microzone=[(zone, site, as_points(rings)) for zone, (site, rings) in zones.items()])
    draw = random.Random(7)
    points = [(i, draw.choice((1, 2)), draw.uniform(-3, 11), draw.uniform(-3, 11)) for i in range(300)]
    frame = spark.createDataFrame([*points, (999, 1, None, 1.0)], "id int, site_id int, latitude double, longitude double")
    expected = sorted(
        (i, zone) for i, site, x, y in points for zone, (where, rings) in zones.items()
        if where == site and reference_inside(rings, x, y)
    )
    assert rows_of(match_zones(frame, zone_shapes(tables)), "id", "microzone_id") == expected


def test_point_in_two_zones_counts_twice(make_tables, rows_of, spark):
    tables = make_tables(
        site=[(1, "R", 1)],
        microzone=[(1, 1, as_points([SQUARE])), (2, 1, as_points([TRIANGLE]))],
        microzone_group=[("G", 1), ("G", 2)],
    )
    points = spark.createDataFrame([(1, "R", 3.5, 3.6)], "id int, region_code string, latitude double, longitude double")
    assert rows_of(match_zone_groups(points, tables), "id", "microzone_group_code", "microzone_id") == [(1, "G", 1), (1, "G", 2)]


def hits(spark, rows_of, tables, *points):
    frame = spark.createDataFrame(list(points), "id int, site_id int, latitude double, longitude double")
    return rows_of(match_zones(frame, zone_shapes(tables)), "id", "microzone_id")


def test_each_row_of_a_zone_counts(make_tables, rows_of, spark):
    tables = make_tables(microzone=[(1, 1, as_points([SQUARE]))] * 2)
    assert hits(spark, rows_of, tables, (7, 1, 1.0, 1.0)) == [(7, 1), (7, 1)]


def test_a_zone_in_parts_counts_once(make_tables, rows_of, spark):
    lower, upper = [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)], [(4.0, 4.0), (4.0, 0.0), (0.0, 4.0)]
    far = [(100.0, 100.0), (180.0, 100.0), (180.0, 180.0), (100.0, 180.0)]
    tables = make_tables(microzone=[(1, 1, as_points([part])) for part in (lower, upper, far)])
    assert hits(spark, rows_of, tables, (7, 1, 1.0, 1.0), (8, 1, 3.0, 3.0), (9, 1, 120.0, 120.0)) == [(7, 1), (8, 1), (9, 1)]


def test_zones_without_outline_hold_nothing(make_tables, rows_of, spark):
    tables = make_tables(microzone=[(1, 1, None), (2, 1, []), (3, 1, as_points([[(1.0, 1.0)]]))])
    assert hits(spark, rows_of, tables, (7, 1, 1.0, 1.0)) == []


def test_a_huge_zone_elsewhere_does_not_coarsen_the_grid(make_tables, spark):
    def box(x, y, side):
        return as_points([[(x, y), (x + side, y), (x + side, y + side), (x, y + side)]])

    small = [(k, 1, box(k % 32 * 0.01, k // 32 * 0.01, 0.009)) for k in range(1024)]
    huge = [(5000, 2, box(-40.0, -40.0, 80.0))]
    for zones in (small, small + huge, small + [(5001, 1, huge[0][2])]):
        placed = zone_shapes(make_tables(microzone=zones)).filter("site_id = 1").withColumn("level", _level())
        per_cell = (
            placed.filter("x_max - x_min < 1")
            .select("level", F.floor(F.col("x_min") / F.pow(F.lit(2.0), "level")).alias("cx"), F.floor(F.col("y_min") / F.pow(F.lit(2.0), "level")).alias("cy"))
            .groupBy("level", "cx", "cy").count().agg(F.max("count")).first()[0]
        )
        assert per_cell <= 4


def covered(spark, rings, points):
    """For each point what the cover says, what all edges say, and how many edges were looked at."""
    shapes = spark.createDataFrame([(1, 1, as_points(rings))], "site_id int, microzone_id int, boundaries array<array<struct<x double, y double>>>")
    tables = Tables({"microzone": shapes})
    frame = spark.createDataFrame([(i, 1, x, y) for i, (x, y) in enumerate(points)], "id int, site_id int, latitude double, longitude double")
    cells = materialize(zone_cells(zone_shapes(tables)), "cells")
    probes = frame.select("*", F.explode(F.array(*[F.lit(v.level) for v in cells.select("level").distinct().collect()])).alias("level"))
    probes = probes.withColumns({"cx": F.floor(F.col("latitude") / F.pow(F.lit(2.0), "level")), "cy": F.floor(F.col("longitude") / F.pow(F.lit(2.0), "level"))})
    seen = probes.join(cells, ["site_id", "level", "cx", "cy"]).groupBy("id").agg(F.count("*").alias("n"), F.max(F.size("edges")).alias("looked"))
    assert seen.filter("n > 1").count() == 0  # one cell of a cover holds a point
    found = {r.id for r in match_zones(frame, zone_shapes(tables)).collect()}
    return found, cells, {r.id: r.looked for r in seen.collect()}


def circle(n, wave=0.0):
    angle = [2 * math.pi * k / n for k in range(n)]
    return [((5 + wave * math.sin(40 * a)) * math.cos(a), (5 + wave * math.sin(40 * a)) * math.sin(a)) for a in angle]


@pytest.mark.parametrize("rings", [
    [circle(50)],
    [circle(3000, 0.7), [(x / 3, y / 3) for x, y in circle(500, 0.2)]],
    [[(x, y) for k in range(120) for x, y in ((k * 0.25, -8.0), (k * 0.25, 8.0), (k * 0.25 + 0.125, 8.0), (k * 0.25 + 0.125, -8.0))]],  # a comb on cell borders
    [[p for k in range(200) for p in ((0.0, 0.0), (8 * math.cos(k * 0.03), 8 * math.sin(k * 0.03)), (8 * math.cos(k * 0.03 + 0.01), 8 * math.sin(k * 0.03 + 0.01)))]],  # edges that meet
])
def test_cover_equals_counting_all_edges(spark, rings):
    draw = random.Random(3)
    points = [(draw.uniform(-9, 9), draw.uniform(-9, 9)) for _ in range(300)]
    points += [(x * 0.25, y * 0.5) for x in range(-8, 40) for y in (-17, -16, -3, 0, 8, 16)]  # on borders and vertices
    found, _, _ = covered(spark, rings, points)
    frame = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    shapes = spark.createDataFrame([(as_points(rings),)], "boundaries array<array<struct<x double, y double>>>").select(edges("boundaries").alias("edges"))
    assert found == {r.id for r in frame.join(F.broadcast(shapes)).filter(inside(F.col("edges"), F.col("x"), F.col("y"))).collect()}


def test_candidates_of_a_zone_with_many_edges_see_few(spark):
    draw = random.Random(5)
    points = [(draw.uniform(-6, 6), draw.uniform(-6, 6)) for _ in range(500)]
    points += [(x * (1 + d), y * (1 + d)) for x, y in circle(50_000)[::200] for d in (-1e-6, 1e-6)]
    found, cells, looked = covered(spark, [circle(50_000)], points)
    assert found == {i for i, (x, y) in enumerate(points) if math.hypot(x, y) < 5}
    assert max(looked.values()) < 100
    sizes = cells.agg(F.count("*").alias("n"), F.sum(F.size("edges")).alias("edges"), F.count_if(F.size("edges") == 0).alias("whole")).first()
    assert sizes.edges < 100_000 and sizes.n < 10_000 and sizes.whole > 100  # no edge is repeated often, and the middle is few cells


def test_zone_with_an_unknown_vertex_holds_nothing(make_tables, rows_of, spark):
    tables = make_tables(microzone=[(1, 1, [[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": None}, {"x": 4.0, "y": 4.0}]])])
    assert hits(spark, rows_of, tables, (7, 1, 3.0, 1.0)) == []
