"""GeoJSON geometries as paths, and exact tests of their segments, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each type's depth of nested arrays above its points, and whether it has an inside.
TYPES = {"Point": (0, False), "MultiPoint": (1, False), "LineString": (1, False), "MultiLineString": (2, False), "Polygon": (2, True), "MultiPolygon": (3, True)}
#: How far the part of a segment in a column of cells is widened, in cells: far more than doubles round.
SLACK = 1e-6


def with_shape(rows: DataFrame, text: str) -> DataFrame:
    """Adds area (boolean) and paths (array<array<array<double>>>) of the geometries in a text column; rows whose text isn't one of TYPES, has no points, or a point without numbers go.

    A path is a ring, a line, or one point. The rings of all polygons lie side by side: a point is inside where a ray from it crosses an odd number of their edges.
    Each step is exploded from an array of one, so that no later expression computes it again.
    """
    once = lambda value, name: F.explode(F.array(value)).alias(name)
    kept = [c for c in rows.columns if c not in ("area", "paths")]
    read = rows.select(*kept, once(F.from_json(text, "type string, coordinates string"), "_outer"))

    def numbers(depth: int) -> Column:
        kind = "double"
        for _ in range(depth + 1):
            kind = f"array<{kind}>"
        return F.from_json("_outer.coordinates", kind)

    of_type = {
        "Point": lambda: F.array(F.array(numbers(0))), "MultiPoint": lambda: F.transform(numbers(1), lambda p: F.array(p)), "LineString": lambda: F.array(numbers(1)),
        "MultiLineString": lambda: numbers(2), "Polygon": lambda: numbers(2), "MultiPolygon": lambda: F.flatten(numbers(3)),
    }
    paths = F.lit(None)
    for name in TYPES:
        paths = F.when(F.col("_outer.type") == name, of_type[name]()).otherwise(paths)
    sound = (F.size("paths") > 0) & F.forall("paths", lambda path: (F.size(path) > 0) & F.forall(path, lambda p: F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull()))
    shaped = read.select(*kept, F.col("_outer.type").isin([t for t, (_, area) in TYPES.items() if area]).alias("area"), once(paths, "paths"))
    return shaped.select(*kept, "area", "paths", once(F.coalesce(sound, F.lit(False)), "_sound")).where("_sound").drop("_sound")


def segments(paths: Column) -> Column:
    """array<struct<ax, ay, bx, by>> of all paths; a lone point is a segment from it to itself."""

    def of(path: Column) -> Column:
        ends = F.sequence(F.lit(1), F.greatest(F.size(path) - 1, F.lit(1)))
        a, b = lambda k: F.element_at(path, k), lambda k: F.element_at(path, F.least(k + 1, F.size(path)))
        return F.transform(ends, lambda k: F.struct(a(k)[0].alias("ax"), a(k)[1].alias("ay"), b(k)[0].alias("bx"), b(k)[1].alias("by")))

    return F.flatten(F.transform(paths, of))


def outer_box(paths: Column) -> list[Column]:
    """West, south, east and north of all paths."""
    points = F.flatten(paths)
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def side(ax: Column, ay: Column, bx: Column, by: Column, x: Column, y: Column) -> Column:
    """Positive, zero or negative as a point lies left of, on, or right of the line from a to b."""
    return (bx - ax) * (y - ay) - (by - ay) * (x - ax)


def segments_meet(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """Whether two segments share a point, ends included; either may be a point."""
    ax, ay, bx, by = a
    cx, cy, dx, dy = b
    near = (F.least(ax, bx) <= F.greatest(cx, dx)) & (F.greatest(ax, bx) >= F.least(cx, dx)) & (F.least(ay, by) <= F.greatest(cy, dy)) & (F.greatest(ay, by) >= F.least(cy, dy))
    c, d = side(*a, cx, cy), side(*a, dx, dy)
    e, f = side(*b, ax, ay), side(*b, bx, by)
    return near & ((c <= 0) | (d <= 0)) & ((c >= 0) | (d >= 0)) & ((e <= 0) | (f <= 0)) & ((e >= 0) | (f >= 0))


def crosses_ray(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Whether an edge crosses the ray from a point to the east. An end counts with the edge above it, so a ray through a corner counts once."""
    return ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / F.nullif(by - ay, F.lit(0.0)) + ax)


def segment_cells(ax: Column, ay: Column, bx: Column, by: Column, cell: float) -> Column:
    """The grid cells (cx, cy) that a segment goes through: column by column, the rows of the part of it that lies there."""
    at = lambda v: F.floor(v / cell)
    west, east = F.least(ax, bx), F.greatest(ax, bx)
    slope = F.coalesce((by - ay) / F.nullif(bx - ax, F.lit(0.0)), F.lit(0.0))

    def rows(cx: Column) -> Column:
        y1 = F.when(ax == bx, ay).otherwise(ay + slope * (F.greatest(west, cx * cell) - ax))
        y2 = F.when(ax == bx, by).otherwise(ay + slope * (F.least(east, (cx + 1) * cell) - ax))
        low, high = F.greatest(F.least(y1, y2) - SLACK * cell, F.least(ay, by)), F.least(F.greatest(y1, y2) + SLACK * cell, F.greatest(ay, by))
        return F.transform(F.sequence(at(F.least(low, high)), at(F.greatest(low, high))), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

    return F.flatten(F.transform(F.sequence(at(west), at(east)), rows))
