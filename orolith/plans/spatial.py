"""Queries of the item store, of bucketed tables and of general geometries, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith.functions import curve
from orolith.operators import geometry, search
from orolith.plans import fixtures as fx
from orolith.plans.queries import BOX, INTERVAL, POLYGON, _items, _scratch, query
from orolith.sources import buckets, itemstore

#: Bits of the Hilbert keys that are compared with SQL.
KEY_BITS = 10
#: A polygon with a hole that many items lie in.
HOLED = {"type": "Polygon", "coordinates": [[[-134.0, 50.0], [-121.0, 49.0], [-119.0, 58.0], [-133.0, 59.0], [-134.0, 50.0]], [[-129.0, 52.0], [-124.0, 52.5], [-125.0, 56.0], [-128.5, 55.0], [-129.0, 52.0]]]}
TRACK = {"type": "LineString", "coordinates": [[-139.5, 48.5], [-128.25, 54.75], [-126.0, 49.5], [-115.5, 59.0]]}


def _quads(s, d) -> DataFrame:
    """Items with a turned quadrilateral as their geometry."""
    corner = lambda k: F.array(f"x{k}", f"y{k}")
    ring = F.array(*[corner(k) for k in (1, 2, 3, 4, 1)])
    return fx.relation(s, d, fx.QUADS).select("item_id", F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))).alias("geometry"))


def _forms(s, d) -> DataFrame:
    """Areas by turns a diamond with a hole, a line, and points."""
    at = lambda x, y: F.array(F.col("cx") + F.col("rx") * x, F.col("cy") + F.col("ry") * y)
    ring = lambda r: F.array(at(r, 0.0), at(0.0, r), at(-r, 0.0), at(0.0, -r), at(r, 0.0))
    form = lambda kind, c: F.to_json(F.struct(F.lit(kind).alias("type"), c.alias("coordinates")))
    text = F.when(F.col("area_id") % 3 == 0, form("Polygon", F.array(ring(1.0), ring(0.5)))).when(F.col("area_id") % 3 == 1, form("LineString", F.array(at(-1.0, -1.0), at(0.0, 1.0), at(1.0, -0.5))))
    return fx.relation(s, d, fx.DIAMONDS).select("area_id", text.otherwise(form("MultiPoint", F.array(at(1.0, 0.0), at(0.0, 1.0), at(-1.0, 0.0), at(0.0, -1.0)))).alias("geometry"))


@query
def hilbert_keys(s, d):
    boxes = (F.col(c) for c in search.BOX)
    return _items(s, d).select("item_id", curve.box_key(*boxes, bits=KEY_BITS).alias("key"))


def _store(s, d) -> str:
    path = _scratch(s, "store")
    itemstore.write_store(_items(s, d), path, per_file=500)
    return path


@query
def store_search_bbox(s, d):
    return itemstore.search_store(s, _store(s, d), bbox=list(BOX)).select("item_id")


@query
def store_search_bbox_datetime(s, d):
    return itemstore.search_store(s, _store(s, d), bbox=list(BOX), interval=INTERVAL).select("item_id")


@query
def store_search_polygon(s, d):
    return itemstore.search_store(s, _store(s, d), intersects=POLYGON).select("item_id")


@query
def store_totals(s, d):
    """The manifest's boxes and numbers, taken together."""
    rows = itemstore.manifest(s, _store(s, d))
    return rows.agg(F.sum("items").alias("items"), F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


@query
def geometry_join_forms(s, d):
    return geometry.geometry_join(_quads(s, d), _forms(s, d), "item_id", "area_id", folder=_scratch(s, "shapes"))


@query
def geometry_join_counts(s, d):
    return geometry_join_forms(s, d).groupBy("area_id").agg(F.count("*").alias("items"))


@query
def search_holed_polygon(s, d):
    return geometry.meeting(_quads(s, d), HOLED, folder=_scratch(s, "shapes")).select("item_id")


@query
def search_track(s, d):
    return search.search(_items(s, d), intersects=TRACK).select("item_id")


@query
def bucketed_upsert(s, d):
    """Items of which some change, some come and some go."""
    path, items = _scratch(s, "buckets"), _items(s, d).select("item_id", "datetime", "west")
    number = F.substring("item_id", 6, 20).cast("long")
    buckets.create(items.where(number % 5 != 1), path, "item_id", buckets=16)
    late = items.where(number % 7 == 0).withColumn("datetime", F.lit("2030-01-01T00:00:00Z"))
    buckets.upsert(late.unionByName(items.where(number % 5 == 1)), path, order="datetime", deleted=items.where(number % 11 == 3).select("item_id"))
    return buckets.read(s, path)


def _hilbert_sql() -> str:
    """One step for each bit, each computed before the next."""
    cell = lambda v, low, size: f"greatest(least(floor((({v}) / 2 - ({low}::DOUBLE)) / {size}::DOUBLE * {1 << KEY_BITS}), {(1 << KEY_BITS) - 1}), 0)::BIGINT"
    steps = [f"h{KEY_BITS} AS MATERIALIZED (SELECT item_id, {cell('west + east', -180.0, 360.0)} AS x, {cell('south + north', -90.0, 180.0)} AS y, 0::BIGINT AS d FROM its)"]
    for k in reversed(range(KEY_BITS)):
        side = 1 << k
        steps.append(f"b{k} AS MATERIALIZED (SELECT item_id, d, (x >> {k}) & 1 AS rx, (y >> {k}) & 1 AS ry, x & {side - 1} AS u, y & {side - 1} AS v FROM h{k + 1})")
        steps.append(f"h{k} AS MATERIALIZED (SELECT item_id, CASE WHEN ry = 1 THEN u WHEN rx = 0 THEN v ELSE {side - 1} - v END AS x, CASE WHEN ry = 1 THEN v WHEN rx = 0 THEN u ELSE {side - 1} - u END AS y, 4 * d + xor(3 * rx, ry) AS d FROM b{k})")
    return f"SELECT item_id, d AS key FROM (WITH {', '.join(steps)} SELECT * FROM h0)"


def _meet_sql(left: str, right: str) -> str:
    """Whether segments of two relations share a point."""
    side = lambda a, x, y: f"(({a}.bx - {a}.ax) * ({y} - {a}.ay) - ({a}.by_ - {a}.ay) * ({x} - {a}.ax))"
    both = lambda a, b: f"least({side(a, b + '.ax', b + '.ay')}, {side(a, b + '.bx', b + '.by_')}) <= 0 AND greatest({side(a, b + '.ax', b + '.ay')}, {side(a, b + '.bx', b + '.by_')}) >= 0"
    spans = " AND ".join(f"least({left}.a{c}, {left}.b{e}) <= greatest({right}.a{c}, {right}.b{e}) AND greatest({left}.a{c}, {left}.b{e}) >= least({right}.a{c}, {right}.b{e})" for c, e in (("x", "x"), ("y", "y_")))
    return f"{spans} AND {both(left, right)} AND {both(right, left)}"


def _pairs_sql(edges: str) -> str:
    """(item_id, area_id) of quads and edges (area_id, path, k, ax, ay, bx, by_, area): every pair of edges, and every first point."""
    ray = lambda p, e: f"({e}.ay > {p}.ay) <> ({e}.by_ > {p}.ay) AND {p}.ax < ({e}.bx - {e}.ax) * ({p}.ay - {e}.ay) / nullif({e}.by_ - {e}.ay, 0) + {e}.ax"
    sides = " UNION ALL ".join(f"SELECT item_id, {k} AS k, x{k} AS ax, y{k} AS ay, x{n} AS bx, y{n} AS by_ FROM quads" for k, n in ((1, 2), (2, 3), (3, 4), (4, 1)))
    return f"""SELECT DISTINCT item_id, area_id FROM (WITH q AS ({sides}), e AS ({edges})
  SELECT q.item_id, e.area_id FROM q, e WHERE {_meet_sql('q', 'e')}
  UNION ALL SELECT q.item_id, e.area_id FROM q, e WHERE q.k = 1 AND e.area AND {ray('q', 'e')} GROUP BY ALL HAVING count(*) % 2 = 1
  UNION ALL SELECT item_id, area_id FROM (SELECT q.item_id, e.area_id, e.path FROM q, e WHERE e.k = 1 AND {ray('e', 'q')} GROUP BY ALL HAVING count(*) % 2 = 1))"""


def _forms_sql() -> str:
    at = lambda x, y: f"cx + rx * {x}, cy + ry * {y}"

    def path(when: int, number: int, points: list[tuple[float, float]], area: bool) -> list[str]:
        rows = []
        for k, (a, b) in enumerate(zip(points, points[1:], strict=False), 1):
            (ax, ay), (bx, by) = at(*a).split(", "), at(*b).split(", ")
            rows.append(f"SELECT area_id, {number} AS path, {k} AS k, {ax} AS ax, {ay} AS ay, {bx} AS bx, {by} AS by_, {area} AS area FROM diamonds WHERE area_id % 3 = {when}")
        return rows

    ring = lambda r: [(r, 0.0), (0.0, r), (-r, 0.0), (0.0, -r), (r, 0.0)]
    parts = [*path(0, 1, ring(1.0), True), *path(0, 2, ring(0.5), True), *path(1, 1, [(-1.0, -1.0), (0.0, 1.0), (1.0, -0.5)], False)]
    for number, p in enumerate(ring(1.0)[:4], 1):
        parts += path(2, number, [p, p], False)
    return " UNION ALL ".join(parts)


def _literal_edges(geometry_: dict) -> str:
    rows = []
    for number, ring in enumerate(geometry_["coordinates"], 1):
        rows += [f"(0, {number}, {k}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE, true)" for k, (a, b) in enumerate(zip(ring, ring[1:], strict=False), 1)]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) t(area_id, path, k, ax, ay, bx, by_, area)"


def _track_sql() -> str:
    """Boxes that a line touches: a segment does where their boxes meet and the corners don't all lie on one side of it."""
    parts = []
    for (ax, ay), (bx, by) in zip(TRACK["coordinates"], TRACK["coordinates"][1:], strict=False):
        sides = [f"(({bx - ax}::DOUBLE) * ({y} - ({ay}::DOUBLE)) - ({by - ay}::DOUBLE) * ({x} - ({ax}::DOUBLE)))" for x in ("west", "east") for y in ("south", "north")]
        parts.append(f"(west <= {max(ax, bx)} AND east >= {min(ax, bx)} AND south <= {max(ay, by)} AND north >= {min(ay, by)} AND least({', '.join(sides)}) <= 0 AND greatest({', '.join(sides)}) >= 0)")
    return f"SELECT item_id FROM its WHERE {' OR '.join(parts)}"


_IN_BOX = f"east >= {BOX[0]} AND west <= {BOX[2]} AND north >= {BOX[1]} AND south <= {BOX[3]}"
_IN_TIME = "datetime >= '2018-01-01T00:00:00Z' AND datetime <= '2020-12-31T00:00:00Z'"
_FORM_PAIRS = _pairs_sql(_forms_sql())
BODIES: dict[str, str] = {
    "hilbert_keys": _hilbert_sql(),
    "store_search_bbox": f"SELECT item_id FROM its WHERE {_IN_BOX}",
    "store_search_bbox_datetime": f"SELECT item_id FROM its WHERE {_IN_BOX} AND {_IN_TIME}",
    "store_totals": "SELECT count(*)::BIGINT AS items, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM its",
    "geometry_join_forms": _FORM_PAIRS,
    "geometry_join_counts": f"SELECT area_id, count(*) AS items FROM ({_FORM_PAIRS}) GROUP BY area_id",
    "search_holed_polygon": f"SELECT item_id FROM ({_pairs_sql(_literal_edges(HOLED))})",
    "search_track": _track_sql(),
    "bucketed_upsert": "SELECT item_id, CASE WHEN n % 7 = 0 THEN '2030-01-01T00:00:00Z' ELSE datetime END AS datetime, west FROM (SELECT *, substring(item_id, 6)::BIGINT AS n FROM its) WHERE n % 7 = 0 OR n % 5 = 1 OR n % 11 <> 3",
}
