"""Map projections, boxes, rings and tiles as column expressions.

NAD83 and WGS84 count as one datum, and both use the GRS80 ellipsoid: the other's
flattening moves a point by less than a tenth of a millimetre. Unsupported codes give null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The GRS80 ellipsoid, UTM, and the provincial Albers projection (EPSG 3005).
A, F_INV = 6378137.0, 298.257222101
K0, FALSE_EAST = 0.9996, 500000.0
ALBERS = {"lat1": 50.0, "lat2": 58.5, "lat0": 45.0, "lon0": -126.0, "east": 1_000_000.0}
CSRS_ZONES = {3154: 7, 3155: 8, 3156: 9, 3157: 10, 2955: 11}
#: Points between the corners of an edge when a box is transformed.
EDGE_POINTS = 21

_f = 1 / F_INV
_n = _f / (2 - _f)
_e2 = _f * (2 - _f)
_radius = A / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_forward = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16, 13 * _n**2 / 48 - 3 * _n**3 / 5, 61 * _n**3 / 240)
_inverse = (_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96, _n**2 / 48 + _n**3 / 15, 17 * _n**3 / 480)
_latitude = (2 * _n - 2 * _n**2 / 3 - 2 * _n**3, 7 * _n**2 / 3 - 8 * _n**3 / 5, 56 * _n**3 / 15)


def _q(lat: float) -> float:
    s, e = math.sin(math.radians(lat)), math.sqrt(_e2)
    return (1 - _e2) * (s / (1 - _e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))


def _m2(lat: float) -> float:
    return math.cos(math.radians(lat)) ** 2 / (1 - _e2 * math.sin(math.radians(lat)) ** 2)


ALBERS_N = (_m2(ALBERS["lat1"]) - _m2(ALBERS["lat2"])) / (_q(ALBERS["lat2"]) - _q(ALBERS["lat1"]))
ALBERS_C = _m2(ALBERS["lat1"]) + ALBERS_N * _q(ALBERS["lat1"])
ALBERS_RHO0 = A * math.sqrt(ALBERS_C - ALBERS_N * _q(ALBERS["lat0"])) / ALBERS_N
_authalic = (_e2 / 3 + 31 * _e2**2 / 180 + 517 * _e2**3 / 5040, 23 * _e2**2 / 360 + 251 * _e2**3 / 3780, 761 * _e2**3 / 45360)


def central_meridian(epsg: Column) -> Column:
    """Of the UTM zone of a code; null for other codes."""
    zone = F.when(epsg.between(32601, 32660), epsg - 32600).when(epsg.between(26907, 26911), epsg - 26900)
    for code, number in CSRS_ZONES.items():
        zone = zone.when(epsg == code, F.lit(number))
    return zone * 6.0 - 183.0


def utm_to_lonlat(x: Column, y: Column, lon0: Column) -> tuple[Column, Column]:
    """Inverse transverse Mercator, Krueger's series to the third order of n."""
    xi, eta = y / (K0 * _radius), (x - FALSE_EAST) / (K0 * _radius)
    xi1 = xi - sum(((F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))) * b for j, b in enumerate(_inverse, 1)), F.lit(0.0))
    eta1 = eta - sum(((F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))) * b for j, b in enumerate(_inverse, 1)), F.lit(0.0))
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi + sum((F.sin(chi * (2 * j)) * d for j, d in enumerate(_latitude, 1)), F.lit(0.0))
    return lon0 + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))), F.degrees(lat)


def lonlat_to_utm(lon: Column, lat: Column, lon0: Column) -> tuple[Column, Column]:
    """Forward transverse Mercator of the same series."""
    s, c = F.sin(F.radians(lat)), 2 * math.sqrt(_n) / (1 + _n)
    t = F.sinh(F.atanh(s) - F.atanh(s * c) * c)
    d = F.radians(lon - lon0)
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(t * t + 1.0))
    east = eta + sum((F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a for j, a in enumerate(_forward, 1)), F.lit(0.0))
    north = xi + sum((F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a for j, a in enumerate(_forward, 1)), F.lit(0.0))
    return east * (K0 * _radius) + FALSE_EAST, north * (K0 * _radius)


def albers_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Inverse Albers equal-area of EPSG 3005, by the authalic latitude."""
    dx, dy = x - ALBERS["east"], F.lit(ALBERS_RHO0) - y
    q = (F.lit(ALBERS_C) - (dx * dx + dy * dy) * (ALBERS_N / A) * (ALBERS_N / A)) / ALBERS_N
    beta = F.asin(q / _q(90.0))
    lat = beta + sum((F.sin(beta * (2 * j)) * a for j, a in enumerate(_authalic, 1)), F.lit(0.0))
    return F.degrees(F.atan2(dx, dy) / ALBERS_N) + ALBERS["lon0"], F.degrees(lat)


def lonlat_to_albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    e = math.sqrt(_e2)
    s = F.sin(F.radians(lat))
    q = (s / (F.lit(1.0) - s * s * _e2) - F.log((F.lit(1.0) - s * e) / (s * e + 1.0)) / (2 * e)) * (1 - _e2)
    rho = F.sqrt(F.lit(ALBERS_C) - q * ALBERS_N) * (A / ALBERS_N)
    theta = F.radians(lon - ALBERS["lon0"]) * ALBERS_N
    return rho * F.sin(theta) + ALBERS["east"], F.lit(ALBERS_RHO0) - rho * F.cos(theta)


def _fields(**columns: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in columns.items()])


def _utm_points(points: Column, lon0: Column) -> Column:
    """utm_to_lonlat over an array of (x, y). Step by step, so that a lambda computes each intermediate once."""
    a = F.transform(points, lambda p: _fields(xi=p["y"] / (K0 * _radius), eta=(p["x"] - FALSE_EAST) / (K0 * _radius)))
    series = lambda p, f, g: sum((f(p["xi"] * (2 * j)) * g(p["eta"] * (2 * j)) * b for j, b in enumerate(_inverse, 1)), F.lit(0.0))
    b = F.transform(a, lambda p: _fields(xi=p["xi"] - series(p, F.sin, F.cosh), eta=p["eta"] - series(p, F.cos, F.sinh)))
    c = F.transform(b, lambda p: _fields(chi=F.asin(F.sin(p["xi"]) / F.cosh(p["eta"])), lon=lon0 + F.degrees(F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])))))
    return F.transform(c, lambda p: _fields(lon=p["lon"], lat=F.degrees(p["chi"] + sum((F.sin(p["chi"] * (2 * j)) * d for j, d in enumerate(_latitude, 1)), F.lit(0.0)))))


def _albers_points(points: Column) -> Column:
    """albers_to_lonlat over an array of (x, y), in steps."""
    a = F.transform(points, lambda p: _fields(dx=p["x"] - ALBERS["east"], dy=F.lit(ALBERS_RHO0) - p["y"]))
    b = F.transform(a, lambda p: _fields(beta=F.asin((F.lit(ALBERS_C) - (p["dx"] * p["dx"] + p["dy"] * p["dy"]) * (ALBERS_N / A) * (ALBERS_N / A)) / ALBERS_N / _q(90.0)), lon=F.degrees(F.atan2(p["dx"], p["dy"]) / ALBERS_N) + ALBERS["lon0"]))
    return F.transform(b, lambda p: _fields(lon=p["lon"], lat=F.degrees(p["beta"] + sum((F.sin(p["beta"] * (2 * j)) * k for j, k in enumerate(_authalic, 1)), F.lit(0.0)))))


def transform_bounds(bounds: Column, epsg: Column) -> Column:
    """Native (left, bottom, right, top) as a lon/lat box; each edge counts with EDGE_POINTS points between its corners.

    In both projections longitude grows along horizontal edges and is extreme at corners on
    vertical ones, and latitude along a horizontal edge turns only at the projection's axis.
    So of all edge points only the corners, and on the lower and upper edge the point nearest
    to the axis, can be extreme: six points give the box that all of them would.
    """
    left, bottom, right, top = (F.get(bounds, k) for k in range(4))
    steps, lon0 = float(EDGE_POINTS + 1), central_meridian(epsg)
    axis = F.when(epsg == 3005, F.lit(ALBERS["east"])).otherwise(F.lit(FALSE_EAST))
    k = F.greatest(F.least(F.round((axis - left) / F.nullif(right - left, F.lit(0.0)) * steps), F.lit(steps)), F.lit(0.0))
    turn = left + (right - left) * (F.coalesce(k, F.lit(0.0)) / steps)
    points = F.array(*[_fields(x=x, y=y) for x in (left, right, turn) for y in (bottom, top)])
    plain = F.transform(points, lambda p: _fields(lon=p["x"], lat=p["y"]))
    placed = F.when(lon0.isNotNull(), _utm_points(points, lon0)).when(epsg == 3005, _albers_points(points)).when(epsg == 4326, plain)
    box = F.aggregate(
        placed, F.array(*[F.lit(v) for v in (1e9, 1e9, -1e9, -1e9)]),
        lambda acc, p: F.array(F.least(acc[0], p["lon"]), F.least(acc[1], p["lat"]), F.greatest(acc[2], p["lon"]), F.greatest(acc[3], p["lat"])),
    )
    known = lon0.isNotNull() | epsg.isin(3005, 4326)
    return F.when(known & (F.size(bounds) == 4), box)


def add_bounds(rows: DataFrame, bounds: str, epsg: str, name: str) -> DataFrame:
    """transform_bounds() as a column of rows. Step by step in scalar columns, so that generated code covers all and computes each step once."""
    kept, steps = rows.columns, float(EDGE_POINTS + 1)
    code, lon0 = F.col(epsg), central_meridian(F.col(epsg))
    corner = {k: F.get(bounds, i) for i, k in enumerate(("left", "bottom", "right", "top"))}
    rows = rows.withColumns({f"_b_{k}": c for k, c in corner.items()}).withColumns({"_b_lon0": lon0, "_b_axis": F.when(code == 3005, F.lit(ALBERS["east"])).otherwise(F.lit(FALSE_EAST))})
    width = F.col("_b_right") - F.col("_b_left")
    at = F.greatest(F.least(F.round((F.col("_b_axis") - F.col("_b_left")) / F.nullif(width, F.lit(0.0)) * steps), F.lit(steps)), F.lit(0.0))
    rows = rows.withColumn("_b_turn", F.col("_b_left") + width * (F.coalesce(at, F.lit(0.0)) / steps))
    xs, ys = ("left", "right", "turn"), ("bottom", "top")
    points = [(x, y) for x in xs for y in ys]
    got = lambda *parts: F.col("_b_" + "_".join(map(str, parts)))
    scale = K0 * _radius
    rows = rows.withColumns({**{f"_b_eta_{x}": (got(x) - FALSE_EAST) / scale for x in xs}, **{f"_b_xi_{y}": got(y) / scale for y in ys}})
    rows = rows.withColumns({**{f"_b_{f.__name__}_{j}_{x}": f(got("eta", x) * (2 * j)) for x in xs for j in (1, 2, 3) for f in (F.sinh, F.cosh)}, **{f"_b_{f.__name__}_{j}_{y}": f(got("xi", y) * (2 * j)) for y in ys for j in (1, 2, 3) for f in (F.sin, F.cos)}})
    series = lambda f, g, x, y: sum((got(f, j, y) * got(g, j, x) * b for j, b in enumerate(_inverse, 1)), F.lit(0.0))
    rows = rows.withColumns({**{f"_b_xi_{x}_{y}": got("xi", y) - series("sin", "cosh", x, y) for x, y in points}, **{f"_b_eta_{x}_{y}": got("eta", x) - series("cos", "sinh", x, y) for x, y in points}})
    dx, dy = {x: got(x) - ALBERS["east"] for x in xs}, {y: F.lit(ALBERS_RHO0) - got(y) for y in ys}
    chi = {f"_b_chi_{x}_{y}": F.asin(F.sin(got("xi", x, y)) / F.cosh(got("eta", x, y))) for x, y in points}
    beta = {f"_b_beta_{x}_{y}": F.asin((F.lit(ALBERS_C) - (dx[x] * dx[x] + dy[y] * dy[y]) * (ALBERS_N / A) * (ALBERS_N / A)) / ALBERS_N / _q(90.0)) for x, y in points}
    rows = rows.withColumns({**chi, **beta})
    wave = lambda v, terms: v + sum((F.sin(v * (2 * j)) * d for j, d in enumerate(terms, 1)), F.lit(0.0))
    pick = lambda utm, albers, plain: F.when(got("lon0").isNotNull(), utm).when(code == 3005, albers).when(code == 4326, plain)
    lon = {f"_b_lon_{x}_{y}": pick(got("lon0") + F.degrees(F.atan2(F.sinh(got("eta", x, y)), F.cos(got("xi", x, y)))), F.degrees(F.atan2(dx[x], dy[y]) / ALBERS_N) + ALBERS["lon0"], got(x)) for x, y in points}
    lat = {f"_b_lat_{x}_{y}": pick(F.degrees(wave(got("chi", x, y), _latitude)), F.degrees(wave(got("beta", x, y), _authalic)), got(y)) for x, y in points}
    rows = rows.withColumns({**lon, **lat})
    all_of = lambda kind: [got(kind, x, y) for x, y in points]
    box = F.array(F.least(*all_of("lon")), F.least(*all_of("lat")), F.greatest(*all_of("lon")), F.greatest(*all_of("lat")))
    known = (got("lon0").isNotNull() | code.isin(3005, 4326)) & (F.size(bounds) == 4)
    return rows.select(*[c for c in kept if c != name], F.when(known, box).alias(name))


def box_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """The closed ring of a box, counter-clockwise from its lower right corner."""
    return F.array(*[F.array(x, y) for x, y in ((east, south), (east, north), (west, north), (west, south), (east, south))])


def box_polygon(box: Column) -> Column:
    w, s, e, n = (F.element_at(box, k) for k in (1, 2, 3, 4))
    return F.struct(F.lit("Polygon").alias("type"), F.array(box_ring(w, s, e, n)).alias("coordinates"))


def box_line(box: Column) -> Column:
    """A box's ring as a line string."""
    w, s, e, n = (F.element_at(box, k) for k in (1, 2, 3, 4))
    return F.struct(F.lit("LineString").alias("type"), box_ring(w, s, e, n).alias("coordinates"))


def ring_box(ring: Column) -> Column:
    """The box around a ring."""
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def boxes_meet(w1: Column, s1: Column, e1: Column, n1: Column, w2: Column, s2: Column, e2: Column, n2: Column) -> Column:
    """Whether two boxes share a point, edges included."""
    return (e1 >= w2) & (w1 <= e2) & (n1 >= s2) & (s1 <= n2)


def _edges(ring: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda k: F.struct(F.element_at(ring, k).alias("a"), F.element_at(ring, k + 1).alias("b")))


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting; points of the edges may fall on either side, which edge crossing settles."""
    crossed = F.filter(_edges(ring), lambda g: ((g["a"][1] > y) != (g["b"][1] > y)) & (x < (g["b"][0] - g["a"][0]) * (y - g["a"][1]) / F.when(g["b"][1] == g["a"][1], F.lit(1.0)).otherwise(g["b"][1] - g["a"][1]) + g["a"][0]))
    return F.size(crossed) % 2 == 1


def _segment_meets_box(a: Column, b: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """Whether a segment touches a box: their boxes meet and the box's corners don't lie strictly on one side."""
    near = boxes_meet(F.least(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), w, s, e, n)
    side = lambda x, y: (b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])
    sides = [side(x, y) for x, y in ((w, s), (w, n), (e, s), (e, n))]
    return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def polygon_meets_box(rings: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """Exact test of a polygon (outer ring, then holes) against a box, touching edges included."""
    touches = F.exists(rings, lambda ring: F.exists(_edges(ring), lambda g: _segment_meets_box(g["a"], g["b"], w, s, e, n)))
    inside = F.size(F.filter(rings, lambda ring: point_in_ring(w, s, ring))) % 2 == 1
    return touches | inside


def tile_x(lon: Column, zoom: int) -> Column:
    return F.floor((lon / 360.0 + 0.5) * float(1 << zoom)).cast("int")


def tile_y(lat: Column, zoom: int) -> Column:
    s = F.sin(F.radians(lat))
    return F.floor((F.lit(0.5) - F.log((s + 1.0) / (F.lit(1.0) - s)) * 0.25 / math.pi) * float(1 << zoom)).cast("int")


def parse_wkt_polygon(text: Column) -> Column:
    """Rings of a POLYGON text as array<array<array<double>>>, null for other texts."""
    body = F.regexp_extract(text, r"(?i)^\s*POLYGON\s*\(\s*(\(.*\))\s*\)\s*$", 1)
    rings = F.regexp_extract_all(body, F.lit(r"\(([^()]*)\)"), 1)
    parsed = F.transform(rings, lambda r: F.transform(F.split(F.trim(r), r"\s*,\s*"), lambda p: F.transform(F.split(F.trim(p), r"\s+"), lambda c: c.try_cast("double"))))
    return F.when(body != "", parsed)


def format_ring(ring: Column) -> Column:
    """Coordinates with one decimal, a pair a line."""
    return F.array_join(F.transform(ring, lambda p: F.format_string("[%.1f, %.1f]", p[0], p[1])), ",\n")


def affine9(transform: Column) -> Column:
    """Six affine terms of a transform and the constant last row."""
    return F.concat(F.slice(transform, 1, 6), F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0)))


def cells(w: Column, s: Column, e: Column, n: Column, size: float) -> Column:
    """The grid cells (cx, cy) that a box touches."""
    at = lambda v: F.floor(v / size).cast("int")
    return F.flatten(F.transform(F.sequence(at(w), at(e)), lambda x: F.transform(F.sequence(at(s), at(n)), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))
