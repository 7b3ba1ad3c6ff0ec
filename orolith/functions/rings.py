"""Rings of map coordinates as lon/lat polygons: edges made finer where a projection bends them, cut at the antimeridian."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolith.functions import geo

#: Where an edge is probed for how far its image leaves the chord.
PROBES = (0.0, 0.25, 0.5, 0.75, 1.0)
#: Pieces beyond what the probes ask for, since a bend may be sharper between them.
MARGIN = 1.25


def lonlat_points(points: Column, epsg: Column) -> Column:
    """An array of (x, y) in a code's coordinates as (lon, lat); null for codes without a projection. Longitudes go on beyond 180."""
    lon0 = geo.central_meridian(epsg)
    plain = F.transform(points, lambda p: F.struct(p["x"].alias("lon"), p["y"].alias("lat")))
    return F.when(lon0.isNotNull(), geo._utm_points(points, lon0)).when(epsg == 3005, geo._albers_points(points)).when(epsg == 4326, plain)


def _between(edge: Column, t: Column) -> tuple[Column, Column]:
    return edge["a"][0] + (edge["b"][0] - edge["a"][0]) * t, edge["a"][1] + (edge["b"][1] - edge["a"][1]) * t


def _closed(points: Column) -> Column:
    return F.when(F.size(points) > 0, F.concat(points, F.slice(points, 1, 1))).otherwise(points)


def _half(ring: Column, bound: float, east: bool) -> Column:
    """The part of a closed ring on one side of a meridian, closed along it; empty where nothing is left."""
    inside = lambda p: (p[0] >= bound) if east else (p[0] <= bound)

    def step(k: Column) -> Column:
        p, q = F.get(ring, k), F.get(ring, k + 1)
        cut = F.array(F.array(F.lit(bound), p[1] + (q[1] - p[1]) * (F.lit(bound) - p[0]) / F.nullif(q[0] - p[0], F.lit(0.0))))
        none = F.slice(F.array(p), 1, 0)
        return F.concat(F.when(inside(p), F.array(p)).otherwise(none), F.when(inside(p) != inside(q), cut).otherwise(none))

    return F.when(F.size(ring) > 1, _closed(F.flatten(F.transform(F.sequence(F.lit(0), F.size(ring) - 2), step)))).otherwise(ring)


def _window(rings: Column, turn: int) -> Column:
    """The part of a polygon that lies turn times 360 degrees east of -180..180, moved there; without an outer ring nothing is left."""
    parts = F.transform(rings, lambda ring: _half(ring, -180.0 + 360.0 * turn, True))
    parts = F.transform(parts, lambda ring: _half(ring, 180.0 + 360.0 * turn, False))
    outer = F.size(F.get(parts, F.lit(0))) >= 4
    moved = F.transform(F.filter(parts, lambda ring: F.size(ring) >= 4), lambda ring: F.transform(ring, lambda p: F.array(p[0] - 360.0 * turn, p[1])))
    return F.when(outer, F.array(moved)).otherwise(F.slice(F.array(rings), 1, 0))


def add_lonlat_shapes(rows: DataFrame, rings: str, epsg: str, name: str, tolerance: float = 1e-6) -> DataFrame:
    """Adds the lon/lat polygons (MultiPolygon coordinates) of closed rings (outer ring, then holes) in the coordinates of a code.

    Each vertex stays; an edge gets as many more points as keep its image within tolerance (degrees) of the chords. A chord's error falls with the square of the number of pieces, so that number
    follows from the greatest distance at PROBES. A polygon beyond 180 degrees becomes one on each side.
    Unknown codes, null rings and rings of fewer than four points have null. All in columns, and each step is exploded from an array of one, so that no later expression computes it again.
    """
    kept = [c for c in rows.columns if c != name]
    code, steps = F.col(epsg), {}

    def add(rows: DataFrame, column: str, value: Column) -> DataFrame:
        steps[column] = True
        return rows.select(*kept, *[c for c in steps if c != column], F.explode(F.array(value)).alias(column))

    sound = (F.size(rings) > 0) & F.forall(rings, lambda ring: F.size(ring) >= 4)
    edges = F.flatten(F.transform(F.col(rings), lambda ring, i: F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda k: F.struct(i.alias("r"), F.element_at(ring, k).alias("a"), F.element_at(ring, k + 1).alias("b")))))
    rows = add(rows, "_edges", F.when(sound, edges))
    at = lambda e, t: F.struct(_between(e, t)[0].alias("x"), _between(e, t)[1].alias("y"))
    rows = add(rows, "_probed", lonlat_points(F.flatten(F.transform("_edges", lambda e: F.array(*[at(e, F.lit(t)) for t in PROBES]))), code))
    n = len(PROBES)

    def pieces(_, i: Column) -> Column:
        placed = [F.get("_probed", i * n + j) for j in range(n)]
        off = [F.hypot(p["lon"] - placed[0]["lon"] - (placed[-1]["lon"] - placed[0]["lon"]) * t, p["lat"] - placed[0]["lat"] - (placed[-1]["lat"] - placed[0]["lat"]) * t) for t, p in zip(PROBES, placed, strict=True)][1:-1]
        return F.greatest(F.ceil(F.sqrt(F.greatest(*off) / tolerance) * MARGIN), F.lit(1)).cast("int")

    rows = add(rows, "_pieces", F.when(F.col("_probed").isNotNull(), F.transform("_edges", pieces)))
    fine = F.flatten(F.zip_with("_edges", "_pieces", lambda e, m: F.transform(F.sequence(F.lit(0), m - 1), lambda k: F.struct(e["r"].alias("r"), _between(e, k / m)[0].alias("x"), _between(e, k / m)[1].alias("y")))))
    rows = add(rows, "_fine", fine)
    rows = add(rows, "_placed", lonlat_points(F.col("_fine"), code))
    marked = F.zip_with("_fine", "_placed", lambda p, q: F.struct(p["r"].alias("r"), F.array(q["lon"], q["lat"]).alias("at")))
    rows = add(rows, "_marked", marked)
    whole = F.transform(F.sequence(F.lit(0), F.size(rings) - 1), lambda i: _closed(F.transform(F.filter("_marked", lambda p: p["r"] == i), lambda p: p["at"])))
    rows = add(rows, "_rings", F.when(F.col("_marked").isNotNull(), whole))
    beyond = F.exists(F.get("_rings", F.lit(0)), lambda p: F.abs(p[0]) > 180.0)
    split = F.concat(*[_window(F.col("_rings"), turn) for turn in (-1, 0, 1)])
    return rows.select(*kept, F.when(beyond, split).when(F.col("_rings").isNotNull(), F.array("_rings")).alias(name))
