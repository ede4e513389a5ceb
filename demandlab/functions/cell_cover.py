"""A polygon as the cells of a quadtree, each with the edges that matter in it.

A cell is split in four while more than ``FEW_EDGES`` edges cross it. A cell that no
edge touches lies wholly inside or outside; those outside are dropped. For a point of
a border cell the edges further right are counted without being looked at: an edge
from y1 up to y2 is crossed where ``[y < y1] xor [y < y2]``, so ends at the same
height cancel and a chain of edges leaves only the heights at which it enters the
cell's part of the plane. What stays of them is one bit (``odd``) and few heights
(``turns``). Comparisons of heights are exact, so the answer is that of counting
all edges.

The whole cover of a polygon is one expression over its edges. A polygon of n edges
is split to a depth of about log2(sqrt(n)) + 2, so it has a multiple of n cells at
most; a cell where many edges meet in one point may keep more than ``FEW_EDGES``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlab.functions import geometry

FEW_EDGES = 32
# Part of a cell's side by which it is widened before edges are called right or left of it.
_SLACK = 1e-6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def cell_of(coordinate: Column, level: Column) -> Column:
    """Number of the cell of side 2^level that holds a coordinate."""
    return F.floor(coordinate / F.pow(F.lit(2.0), level))


def depth(edges: Column) -> Column:
    """How often the cells of a polygon are halved at most; 0 for few edges."""
    halvings = F.ceil(F.log2(F.sqrt(F.size(edges)))).cast("int") + 2
    return F.when(F.size(edges) > FEW_EDGES, halvings).otherwise(0)


def _box(level: Column, cx: Column, cy: Column) -> Column:
    def placed(side: Column) -> Column:
        return F.struct(
            level.alias("level"), cx.alias("cx"), cy.alias("cy"),
            (cx * side).alias("x0"), ((cx + 1) * side).alias("x1"),
            (cy * side).alias("y0"), ((cy + 1) * side).alias("y1"), (side * _SLACK).alias("slack"),
        )

    return _let(F.pow(F.lit(2.0), level), placed)


def _place(e: Column, box: Column) -> Column:
    """0 for an edge that may touch the box, 1 if it passes on the right, -1 if it is never crossed from there."""
    heights = (box["y0"] - box["slack"], box["y1"] + box["slack"])
    # The side falls with x, so the extremes are on the left and on the right border.
    lowest = F.least(*[geometry.side(e, box["x1"] + box["slack"], y) for y in heights])
    highest = F.greatest(*[geometry.side(e, box["x0"] - box["slack"], y) for y in heights])
    return (
        F.when((e["y2"] < box["y0"]) | (e["y1"] > box["y1"]) | (F.greatest(e["x1"], e["x2"]) < box["x0"]), -1)
        .when(F.least(e["x1"], e["x2"]) > box["x1"], 1)
        .when(lowest > 0, 1)
        .when(highest < 0, -1)
        .otherwise(0)
    )


def _odd_ones(heights: Column) -> Column:
    """The heights that occur an odd number of times."""

    def step(kept: Column, height: Column) -> Column:
        same = F.try_element_at(kept, F.lit(-1)) == height
        return F.when(same, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(F.concat(kept, F.array(height)))

    return F.aggregate(F.array_sort(heights), F.array().cast("array<double>"), step)


def _cell(box: Column, edges: Column, odd: Column, turns: Column) -> Column:
    """The cell on a box, from the edges, bit and heights of a cell around it."""

    def of_heights(placed: Column, heights: Column) -> Column:
        return F.struct(
            box["level"].alias("level"),
            box["cx"].alias("cx"),
            box["cy"].alias("cy"),
            F.transform(F.filter(placed, lambda p: p["place"] == 0), lambda p: p["edge"]).alias("edges"),
            ((odd + F.size(F.filter(heights, lambda y: y >= box["y1"]))) % 2).cast("int").alias("odd"),
            _odd_ones(F.filter(heights, lambda y: y < box["y1"])).alias("turns"),
        )

    def of_placed(placed: Column) -> Column:
        right = F.transform(
            F.filter(placed, lambda p: p["place"] == 1), lambda p: F.array(p["edge"]["y1"], p["edge"]["y2"])
        )
        heights = F.filter(F.concat(turns, F.flatten(right)), lambda y: y > box["y0"])
        return _let(heights, lambda known: of_heights(placed, known))

    return _let(F.transform(edges, lambda e: F.struct(e.alias("edge"), _place(e, box).alias("place"))), of_placed)


def _not_outside(cells: Column) -> Column:
    return F.filter(cells, lambda c: (F.size(c["edges"]) > 0) | (c["odd"] == 1) | (F.size(c["turns"]) > 0))


def _split(cell: Column) -> Column:
    quarters = F.array(
        *[_box(cell["level"] - 1, cell["cx"] * 2 + right, cell["cy"] * 2 + above) for right in (0, 1) for above in (0, 1)]
    )
    parts = _not_outside(F.transform(quarters, lambda box: _cell(box, cell["edges"], cell["odd"], cell["turns"])))
    return F.when(F.size(cell["edges"]) > FEW_EDGES, parts).otherwise(F.array(cell))


def cover(edges: Column, level: Column, x_range: tuple[Column, Column], y_range: tuple[Column, Column]) -> Column:
    """The cells of a polygon as ``array<struct<level, cx, cy, edges, odd, turns>>``, none of them twice.

    ``level`` names a cell side (2^level) no less than the polygon's longer side.
    """
    columns, rows = (F.sequence(cell_of(low, level), cell_of(high, level)) for low, high in (x_range, y_range))
    boxes = F.flatten(F.transform(columns, lambda cx: F.transform(rows, lambda cy: _box(level, cx, cy))))
    nothing = F.array().cast("array<double>")
    start = _not_outside(F.transform(boxes, lambda box: _cell(box, edges, F.lit(0), nothing)))
    halvings = depth(edges)
    steps = F.when(halvings > 0, F.sequence(F.lit(1), halvings)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, lambda cells, _: F.flatten(F.transform(cells, _split)))


def inside_cell(edges: Column, odd: Column, turns: Column, x: Column, y: Column) -> Column:
    """True when a point of the cell is strictly inside the polygon."""
    right = odd + F.size(F.filter(turns, lambda height: y < height))
    crossed = F.size(F.filter(edges, lambda e: geometry.crosses(e, x, y)))
    return ((right + crossed) % 2 == 1) & ~F.exists(edges, lambda e: geometry.touches(e, x, y))
