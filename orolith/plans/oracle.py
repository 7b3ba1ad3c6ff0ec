"""DuckDB SQL with the meaning of each catalog query, over the same projections of the tables."""

from __future__ import annotations

import math

from orolith import schema
from orolith.functions import geo
from orolith.plans import fixtures as fx
from orolith.plans import queries as q
from orolith.plans import exchange, spatial

_SOURCE = len(schema.SOURCE)
_FIX = "CASE WHEN url LIKE 'https:/%' AND url NOT LIKE 'https://%' THEN 'https://' || substring(url, 8) ELSE url END"
_ID = rf"regexp_replace(replace(regexp_replace(substring(url, {_SOURCE + 1}), '^/+', ''), '/', '-'), '\.tif$', '')"
_PUBLISHED = f"'{schema.PUBLISHED}/' || {_ID} || '.json'"
_DATES = rf"""SELECT *, CASE WHEN ds IS NULL THEN '2000-01-01T00:00:00Z' ELSE strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS datetime, ds IS NULL AS datetime_unknown,
  coalesce(length(ds) = 8 AND moment IS NULL, false) AS bad FROM (
  SELECT *, CASE WHEN length(ds) = 8 THEN try_strptime(ds, '%Y%m%d') WHEN length(ds) = 4 THEN try_strptime(ds, '%Y') END AS moment FROM (
  SELECT *, CASE WHEN try_cast(substring(u, 1, 4) AS INT) BETWEEN 2000 AND 2050 THEN u WHEN try_cast(y AS INT) BETWEEN 2000 AND 2050 THEN y END AS ds FROM (
  SELECT *, regexp_extract(url, '_utm\d{{1,2}}_([0-9]{{4,8}})', 1) AS u, regexp_extract(url, '/(2[0-9]{{3}})/', 1) AS y FROM %s)))"""
_LON0 = "CASE WHEN epsg BETWEEN 26907 AND 26911 THEN (epsg - 26900) * 6.0 - 183.0 WHEN epsg BETWEEN 32601 AND 32660 THEN (epsg - 32600) * 6.0 - 183.0 WHEN epsg BETWEEN 3154 AND 3157 THEN (epsg - 3147) * 6.0 - 183.0 WHEN epsg = 2955 THEN -117.0 END"


def _dates(table: str) -> str:
    return _DATES.replace("{{", "{").replace("}}", "}").replace("%s", table)


def _with(body: str) -> str:
    """The projections as common table expressions before a query."""
    names = {"inv": fx.INVENTORY, "fresh": fx.FRESH, "cached": fx.CACHED, "checks": fx.CHECKS, "report": fx.REPORT, "backing": fx.BACKING, "probes": fx.PROBES, "its": fx.ITEMS, "areas": fx.AREAS, "diamonds": fx.DIAMONDS, "quads": fx.QUADS, "local_": fx.LOCAL, "remote": fx.REMOTE}
    derived = {
        "looked": f"SELECT {_FIX} AS key, arg_max(struct_pack(is_geotiff := is_geotiff, is_cog := is_cog, epsg := epsg, height := height, width := width, transform := transform, bounds := bounds), ordinal) AS c FROM checks GROUP BY 1",
        "resolved": f"""SELECT ordinal, {_ID} AS item_id, {_FIX} AS href, datetime, datetime_unknown, c.is_cog AS is_cog, c.is_geotiff AS is_geotiff, c.epsg AS epsg, c.height AS height, c.width AS width, c.transform AS transform, c.bounds AS bounds,
  CASE WHEN c.is_geotiff IS NULL THEN 'no_cache' WHEN NOT c.is_geotiff THEN 'unreadable' WHEN bad THEN 'bad_date' WHEN c.epsg IS NULL OR c.transform IS NULL OR c.bounds IS NULL THEN 'needs_remote' WHEN datetime IS NULL THEN 'error' ELSE 'built' END AS status
  FROM ({_dates("inv")}) d LEFT JOIN looked ON {_FIX} = key""",
        "links": f"SELECT f.ordinal, {_PUBLISHED} AS href, ({_PUBLISHED}) NOT IN (SELECT {_PUBLISHED} FROM inv WHERE ordinal % 5 <> 1) AS added FROM fresh f",
        "boxes": _boxes(), "pairs": "SELECT item_id, area_id FROM its i JOIN areas a ON i.east >= a.west AND i.west <= a.east AND i.north >= a.south AND i.south <= a.north",
        "diffs": "SELECT l.name, r.name IS NULL AS missing, CASE WHEN r.name IS NULL THEN '' ELSE concat_ws(',', " + ", ".join(f"CASE WHEN l.{f} IS DISTINCT FROM r.{f} THEN '{f}' END" for f in ("id", "datetime", "datetime_unknown", "geometry", "bbox", "asset_count")) + ") END AS differences FROM local_ l LEFT JOIN remote r ON l.name = r.name",
        "summed": "SELECT sum(f)::BIGINT AS fresh, sum(c)::BIGINT AS cached, count(*) FILTER (f > 0 AND c = 0) AS new, count(*) FILTER (f = 0 AND c > 0) AS deleted, count(*) FILTER (f > 0 AND c > 0) AS unchanged FROM (SELECT url, sum(f) AS f, sum(c) AS c FROM (SELECT url, 1 AS f, 0 AS c FROM fresh UNION ALL SELECT url, 0, 1 FROM cached) GROUP BY url)",
    }
    order, need = ["looked", "resolved", "boxes", "links", "pairs", "diffs", "summed"], {}
    text = body
    for name in reversed(order):
        if name in text:
            need[name] = derived[name]
            text += derived[name]
    used = {n: s for n, s in names.items() if n in text}
    parts = [f"{n} AS ({fx.as_duckdb(s)})" for n, s in used.items()] + [f"{n} AS ({need[n]})" for n in order if n in need]
    return f"WITH {', '.join(parts)} {body}" if parts else fx.as_duckdb(body)


def _boxes() -> str:
    """Boxes of built items: every edge point through the inverse projections, as in published formulas."""
    cosh, sinh = (lambda v: f"((exp({v}) + exp(-({v}))) / 2)"), (lambda v: f"((exp({v}) - exp(-({v}))) / 2)")

    def hyp(x: str, y: str, f: str, g, cs) -> str:
        return " + ".join(f"{c!r} * {f}({2 * j} * {x}) * {g(f'{2 * j} * {y}')}" for j, c in enumerate(cs, 1))

    k = geo.K0 * geo._radius
    return f"""
SELECT ordinal, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM (
SELECT ordinal, CASE WHEN lon0 IS NULL THEN degrees(atan2(dx, dy) / {geo.ALBERS_N!r}) + {geo.ALBERS["lon0"]!r} ELSE lon0 + degrees(atan2({sinh("eta1")}, cos(xi1))) END AS lon,
  degrees(CASE WHEN lon0 IS NULL THEN beta + {" + ".join(f"{c!r} * sin({2 * j} * beta)" for j, c in enumerate(geo._authalic, 1))} ELSE chi + {" + ".join(f"{c!r} * sin({2 * j} * chi)" for j, c in enumerate(geo._latitude, 1))} END) AS lat FROM (
SELECT *, CASE WHEN lon0 IS NOT NULL THEN asin(sin(xi1) / {cosh("eta1")}) END AS chi, CASE WHEN lon0 IS NULL THEN asin(({geo.ALBERS_C!r} - (dx * dx + dy * dy) * {geo.ALBERS_N / geo.A!r} * {geo.ALBERS_N / geo.A!r}) / {geo.ALBERS_N!r} / {geo._q(90.0)!r}) END AS beta FROM (
SELECT *, CASE WHEN lon0 IS NOT NULL THEN xi - ({hyp("xi", "eta", "sin", cosh, geo._inverse)}) END AS xi1, CASE WHEN lon0 IS NOT NULL THEN eta - ({hyp("xi", "eta", "cos", sinh, geo._inverse)}) END AS eta1 FROM (
SELECT ordinal, lon0, y / {k!r} AS xi, (x - 500000.0) / {k!r} AS eta, x - {geo.ALBERS["east"]!r} AS dx, {geo.ALBERS_RHO0!r} - y AS dy FROM (
SELECT ordinal, {_LON0} AS lon0, unnest([l + (r - l) * (i / 22.0::DOUBLE), l + (r - l) * (i / 22.0::DOUBLE), l, r]) AS x, unnest([b, t, b + (t - b) * (i / 22.0::DOUBLE), b + (t - b) * (i / 22.0::DOUBLE)]) AS y
FROM (SELECT ordinal, epsg, bounds[1] AS l, bounds[2] AS b, bounds[3] AS r, bounds[4] AS t, unnest(range(23)) AS i FROM resolved WHERE status = 'built')))))) GROUP BY ordinal"""


_BOX = "east >= {0} AND west <= {2} AND north >= {1} AND south <= {3}".format(*q.BOX)
_TIME = "datetime >= '2018-01-01' AND datetime <= '2020-12-31T00:00:00Z'"
_FIRST = "SELECT min(ordinal) AS ordinal, url FROM {a} WHERE url NOT IN (SELECT url FROM {b}) GROUP BY url"
_STAC = lambda n: f"'STAC validation error: {n}'"

_BODY = "concat_ws('|', datetime, datetime_unknown::VARCHAR)"
#: Edges of the searched polygon, counter-clockwise: a box meets a convex outline where their boxes meet and no edge has the whole box on its outer side.
_POINTS = q.POLYGON["coordinates"][0]
_CONVEX = " AND ".join(
    [f"east >= {min(p[0] for p in _POINTS)} AND west <= {max(p[0] for p in _POINTS)} AND north >= {min(p[1] for p in _POINTS)} AND south <= {max(p[1] for p in _POINTS)}"]
    + [f"greatest({', '.join(f'({bx} - ({ax})) * ({y} - ({ay})) - ({by} - ({ay})) * ({x} - ({ax}))' for x in ('west', 'east') for y in ('south', 'north'))}) >= 0" for (ax, ay), (bx, by) in zip(_POINTS, _POINTS[1:])]
)
_TENTH = "round({0}::VARCHAR::DECIMAL(38, 20), 1)::DECIMAL(18, 1)::VARCHAR"
_RING = " || chr(44) || chr(10) || ".join(f"'[' || {_TENTH.format(x)} || ', ' || {_TENTH.format(y)} || ']'" for x, y in (("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"), ("east", "south")))


def _forward() -> str:
    """Transverse Mercator by Krueger's series and the equal-area cone, as in published formulas."""
    cosh, sinh, atanh = (lambda v: f"((exp({v}) + exp(-({v}))) / 2)"), (lambda v: f"((exp({v}) - exp(-({v}))) / 2)"), (lambda v: f"(0.5 * ln((1 + ({v})) / (1 - ({v}))))")
    c, k, e = 2 * math.sqrt(geo._n) / (1 + geo._n), geo.K0 * geo._radius, math.sqrt(geo._e2)
    east = " + ".join(f"{a!r} * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, a in enumerate(geo._forward, 1))
    north = " + ".join(f"{a!r} * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, a in enumerate(geo._forward, 1))
    return f"""
SELECT item_id, round((eta + {east}) * {k!r} + 500000.0, 3) AS x, round((xi + {north}) * {k!r}, 3) AS y,
  round(rho * sin(theta) + {geo.ALBERS["east"]!r}, 3) AS albers_x, round({geo.ALBERS_RHO0!r} - rho * cos(theta), 3) AS albers_y FROM (
SELECT item_id, atan2(t, cos(d)) AS xi, {atanh("sin(d) / sqrt(t * t + 1)")} AS eta, {geo.A / geo.ALBERS_N!r} * sqrt({geo.ALBERS_C!r} - {geo.ALBERS_N!r} * q) AS rho, {geo.ALBERS_N!r} * radians(west - {geo.ALBERS["lon0"]!r}) AS theta FROM (
SELECT *, {sinh(f"{atanh('s')} - {c!r} * {atanh(f's * {c!r}')}")} AS t, radians(west + 123.0) AS d, {1 - geo._e2!r} * (s / (1 - {geo._e2!r} * s * s) - ln((1 - {e!r} * s) / (1 + {e!r} * s)) / {2 * e!r}) AS q FROM (SELECT item_id, west, sin(radians(south)) AS s FROM its)))"""


_BODIES: dict[str, str] = {
    "item_rows": f"SELECT ordinal, {_ID} AS item_id, {_FIX} AS href, datetime, datetime_unknown, CASE WHEN ds IS NULL THEN 'unknown' WHEN bad THEN 'bad_date' WHEN moment IS NULL THEN 'error' ELSE 'built' END AS status FROM ({_dates('inv')})",
    "url_fix_scheme": f"SELECT ordinal, {_FIX} AS href FROM inv",
    "url_encode_space": f"SELECT ordinal, replace(url, ' ', '%20') AS encoded, '/vsicurl/' || replace({_FIX}, ' ', '%20') AS opened FROM inv",
    "url_item_id": f"SELECT ordinal, {_ID} AS item_id FROM inv",
    "id_to_url_lossy": f"SELECT ordinal, '{schema.SOURCE}/' || replace({_ID}, '-', '/') || '.tif' AS url FROM inv",
    "pages_url_parts": rf"SELECT page_id, {_FIX} AS fixed, stem, regexp_replace(url, '/$', '') AS stripped, '{schema.PUBLISHED}/' || stem || '.json' AS published FROM (SELECT *, CASE WHEN name LIKE '_%.%' THEN regexp_replace(name, '(.)\.[^.]*$', '\1') ELSE name END AS stem FROM (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages))",
    "date_extract": f"SELECT ordinal, ds AS date_text FROM ({_dates('inv')})",
    "datetime_parse": f"SELECT ordinal, strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS parsed, bad FROM ({_dates('inv')})",
    "datetime_placeholder": f"SELECT ordinal, datetime, datetime_unknown FROM ({_dates('inv')})",
    "inventory_filter_paren": "SELECT ordinal, url FROM inv WHERE NOT contains(url, '(')",
    "inventory_pattern": "SELECT * FROM (SELECT p_partkey, p_name || CASE WHEN p_partkey % 3 = 0 THEN '.tif' ELSE '.txt' END || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '.dem.tif' END AS name FROM part) WHERE name LIKE '%dem%' AND name LIKE '%.tif'",
    "nonblank_lines": f"SELECT ordinal, {_FIX} AS url FROM inv WHERE ordinal % 8 <> 0",
    "changes_new": _FIRST.format(a="fresh", b="cached"),
    "changes_deleted": _FIRST.format(a="cached", b="fresh"),
    "changes_unchanged_count": "SELECT count(*) AS unchanged FROM (SELECT url FROM fresh INTERSECT SELECT url FROM cached)",
    "changes_summary": "SELECT *, cached > 0 AND fresh < 0.9 * cached AS refused, new > 0 OR deleted > 0 AS changed, CASE WHEN cached > 0 AND fresh < 0.9 * cached THEN 2 WHEN new > 0 OR deleted > 0 THEN 1 ELSE 0 END AS exit_code FROM summed",
    "changes_guard": "SELECT *, fresh < 0.9 * cached AS refused, CASE WHEN fresh < 0.9 * cached THEN 2 ELSE 1 END AS exit_code FROM (SELECT (SELECT count(*) FROM fresh WHERE ordinal % 3 <> 0) AS fresh, (SELECT count(*) FROM cached) AS cached)",
    "reconcile_backed": f"SELECT ordinal, url FROM inv WHERE {_ID} IN (SELECT {_ID} FROM backing)",
    "reconcile_orphaned": f"SELECT ordinal, url FROM inv WHERE {_ID} NOT IN (SELECT {_ID} FROM backing)",
    "reconcile_counts": f"SELECT count(*) AS total, count(*) FILTER (b) AS backed, count(*) FILTER (NOT b) AS orphaned FROM (SELECT {_ID} IN (SELECT {_ID} FROM backing) AS b FROM inv)",
    "cache_last_wins": "SELECT key, c.is_geotiff AS is_geotiff, c.is_cog AS is_cog, coalesce(c.epsg, 0) AS epsg, c.transform IS NOT NULL AS has_transform FROM looked",
    "cache_missing": "SELECT ordinal, url FROM inv WHERE url NOT IN (SELECT url FROM checks)",
    "cache_needs_upgrade": "SELECT ordinal, url FROM checks WHERE is_geotiff AND transform IS NULL",
    "cache_delta": "SELECT ordinal, url FROM inv WHERE url NOT IN (SELECT url FROM checks) OR url IN (SELECT url FROM checks WHERE is_geotiff AND transform IS NULL)",
    "cache_union": "SELECT ordinal, url, is_geotiff, is_cog, coalesce(epsg, 0) AS epsg FROM checks WHERE url NOT IN (SELECT url FROM checks WHERE is_geotiff AND transform IS NULL) UNION ALL SELECT ordinal, url, true, false, 0 FROM inv WHERE url NOT IN (SELECT url FROM checks) OR url IN (SELECT url FROM checks WHERE is_geotiff AND transform IS NULL)",
    "item_status": "SELECT ordinal, item_id, status FROM resolved",
    "item_status_counts": "SELECT *, bad_date > 0 AS batch_poisoned, detected - built AS shortfall, built > 0 AS gate_open FROM (SELECT count(*) AS detected, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("built", "no_cache", "unreadable", "bad_date", "needs_remote", "error")) + " FROM resolved)",
    "item_media_type": f"SELECT ordinal, CASE WHEN is_cog THEN '{schema.MEDIA_TYPE_COG}' ELSE '{schema.MEDIA_TYPE}' END AS media_type FROM resolved WHERE is_geotiff",
    "item_links_delta": "SELECT * FROM links",
    "item_links_counts": "SELECT count(*) FILTER (added) AS added, count(*) FILTER (NOT added) AS skipped FROM links",
    "item_proj_fields": "SELECT ordinal, " + ", ".join(f"transform[{k}] AS t{k}" for k in range(1, 7)) + ", 0::DOUBLE AS t7, 0::DOUBLE AS t8, 1::DOUBLE AS t9, height AS rows, width AS cols, bounds[1] AS \"left\", bounds[4] AS top FROM resolved WHERE transform IS NOT NULL",
    "item_wgs84_bbox": "SELECT ordinal, round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, round(north, 6) AS north FROM boxes",
    "collection_bbox_union": "SELECT round(min(west), 6) AS west, round(min(south), 6) AS south, round(max(east), 6) AS east, round(max(north), 6) AS north, count(*) = 0 AS empty FROM boxes",
    "item_document_json": f"SELECT ordinal, item_id AS id, 'Feature' AS type, '1.1.0' AS stac_version, datetime, CASE WHEN datetime_unknown THEN 'true' END AS datetime_unknown, epsg, href, CASE WHEN is_cog THEN '{schema.MEDIA_TYPE_COG}' ELSE '{schema.MEDIA_TYPE}' END AS media_type, 'collection' AS rel, '{schema.COLLECTION_ID}' AS collection FROM resolved WHERE status = 'built'",
    "temporal_extent": f"SELECT strftime(min(moment), '%Y-%m-%dT%H:%M:%SZ') AS first, strftime(max(moment), '%Y-%m-%dT%H:%M:%SZ') AS last, count(moment) AS dated, count(moment) = 0 AS empty, count(*) FILTER (bad) AS bad_dates FROM ({_dates('inv')})",
    "collection_summary": f"""SELECT 'CC-BY-4.0' AS license, 1::BIGINT AS own_links, -140::DOUBLE AS west, first, last, links, item_links, first_href, digest FROM (SELECT strftime(min(moment), '%Y-%m-%dT%H:%M:%SZ') AS first, strftime(max(moment), '%Y-%m-%dT%H:%M:%SZ') AS last FROM ({_dates('inv')})),
  (SELECT count(*) AS links, count(*) FILTER (rel = 'item') AS item_links, arg_min(href, ordinal) AS first_href, sum(('0x' || substr(md5(ordinal || '|' || rel || '|' || href), 1, 8))::BIGINT)::BIGINT AS digest FROM (SELECT ordinal, CASE WHEN ordinal % 1000 = 0 THEN 'child' ELSE 'item' END AS rel, {_PUBLISHED} AS href FROM inv))""",
    "tile_index": "SELECT item_id, floor(((west + east) / 2 / 360.0 + 0.5) * 4096)::INT AS x, floor((0.5 - 0.25 * ln((1 + sin(radians((south + north) / 2))) / (1 - sin(radians((south + north) / 2)))) / pi()) * 4096)::INT AS y, 12 AS z FROM its",
    "validate_report": f"""SELECT 'e-' || event_id AS item_id, n <> 6 AS json_exists, error IS NULL AS json_valid, error FROM (SELECT event_id, event_id % 19 AS n, CASE WHEN event_id % 19 = 6 THEN 'File not found' WHEN event_id % 23 = 7 THEN 'JSON decode error' WHEN event_id % 7 = 1 THEN {_STAC('type')}
  WHEN event_id % 11 = 2 THEN {_STAC('geometry')} WHEN event_id % 13 = 3 THEN {_STAC('bbox')} WHEN event_id % 5 = 4 THEN {_STAC('datetime')} WHEN event_id % 17 = 5 THEN {_STAC('collection')} END AS error FROM events)""",
    "validate_by_schema": """SELECT event_id, CASE WHEN event_id % 19 = 6 THEN ' missing' WHEN event_id % 23 = 7 THEN ' json' ELSE concat_ws(', ', CASE WHEN event_id % 7 = 1 THEN '/type const' END, CASE WHEN event_id % 13 = 3 THEN '/bbox oneOf' END,
  CASE WHEN event_id % 5 = 4 THEN '/properties/datetime format' END, CASE WHEN event_id % 17 = 5 THEN ' required collection' END) END AS errors FROM events""",
    "validate_summary": "SELECT *, CASE WHEN total > 0 THEN round(valid / total * 100, 1) ELSE 0 END AS percent, CASE WHEN invalid > 0 THEN 1 ELSE 0 END AS exit_code FROM (SELECT count(*) AS total, count(*) FILTER (json_valid) AS valid, count(*) FILTER (NOT json_valid) AS invalid FROM report)",
    "validate_incremental": "SELECT item_id FROM report WHERE item_id NOT IN (SELECT item_id FROM report WHERE item_id LIKE '%1' OR item_id LIKE '%2')",
    "validate_incremental_status": "SELECT *, CASE WHEN checked > 0 AND invalid > 0 THEN 1 ELSE 0 END AS exit_code FROM (SELECT count(*) FILTER (item_id LIKE '%2') AS checked, count(*) FILTER (NOT json_valid) AS invalid FROM report)",
    "invalid_to_url_join": f"SELECT b.item_id, i.url FROM (SELECT {_ID} AS item_id FROM backing WHERE NOT json_valid) b JOIN (SELECT DISTINCT {_ID} AS item_id, url FROM inv) i USING (item_id)",
    "invalid_to_url_lossy": f"SELECT item_id, '{schema.SOURCE}/' || replace(item_id, '-', '/') || '.tif' AS url FROM report WHERE NOT json_valid",
    "access_classify": "SELECT url, coalesce(CASE WHEN failure IS NULL THEN status END, -1) AS status_code, coalesce(status = 200, false) AND failure IS NULL AS accessible, CASE WHEN failure IS NOT NULL THEN failure WHEN status = 200 THEN '' ELSE coalesce(reason, '') END AS error, '2026-01-01T00:00:00Z' AS last_checked FROM probes",
    "access_delta": "SELECT url FROM probes WHERE url NOT IN (SELECT url FROM probes WHERE event_id % 3 = 0)",
    "access_exit_status": "SELECT checked, CASE WHEN checked > 0 THEN new ELSE old END AS inaccessible, CASE WHEN CASE WHEN checked > 0 THEN new ELSE old END > 0 THEN 1 ELSE 0 END AS exit_code FROM (SELECT count(*) FILTER (url LIKE '%2.tif') AS checked, count(*) FILTER (url LIKE '%2.tif' AND NOT ok) AS new, count(*) FILTER (url NOT LIKE '%2.tif' AND NOT ok) AS old FROM (SELECT url, coalesce(status = 200, false) AND failure IS NULL AS ok FROM probes))",
    "qa_diff": "SELECT * FROM diffs",
    "qa_summary": "SELECT *, different = 0 AND errors = 0 AS passed FROM (SELECT count(*) FILTER (NOT missing) AS checked, count(*) FILTER (differences <> '') AS different, count(*) FILTER (missing) AS errors FROM diffs)",
    "qa_sample_size": "SELECT greatest(1, least(floor(n * 1 / 100), 100))::BIGINT AS size, greatest(1, least(floor(n * 5 / 100), 200))::BIGINT AS larger FROM (SELECT count(*) AS n FROM local_)",
    "search_bbox": f"SELECT item_id FROM its WHERE {_BOX}",
    "search_datetime": f"SELECT item_id, datetime FROM its WHERE collection = 'elevation' AND {_TIME}",
    "search_bbox_datetime": f"SELECT item_id FROM its WHERE {_BOX} AND {_TIME}",
    "search_unknown_flag": f"SELECT item_id FROM its WHERE {_BOX} AND datetime_unknown",
    "search_page": f"SELECT item_id FROM its WHERE {_BOX} ORDER BY item_id LIMIT 20 OFFSET 40",
    "search_named_area": "SELECT item_id, area_id FROM pairs WHERE area_id IN (SELECT area_id FROM areas WHERE name = 'NATION_3')",
    "spatial_join_grid": "SELECT * FROM pairs",
    "spatial_join_counts": "SELECT area_id, count(*) AS items FROM pairs GROUP BY area_id",
    # a box meets a diamond where its point nearest to the middle, measured in half diagonals along both axes, is at most 1 off
    "spatial_join_polygons": "SELECT item_id, area_id FROM its, diamonds WHERE greatest(west - cx, cx - east, 0) / rx + greatest(south - cy, cy - north, 0) / ry <= 1",
    "search_polygon": f"SELECT item_id FROM its WHERE {_CONVEX}",
    "geometry_forms": f"SELECT item_id, west, south, east, north, {_RING} AS text, 5 AS points FROM its",
    "qa_sampled": "SELECT * FROM diffs WHERE name IN (SELECT name FROM local_ ORDER BY md5(name || '/0'), name LIMIT (SELECT greatest(1, least(floor(count(*) * 5 / 100), 100))::BIGINT FROM local_))",
    "crs_forward": _forward(),
    "crs_round_trip": "SELECT item_id, round(west, 5) AS lon, round(south, 5) AS lat, round(west, 5) AS albers_lon, round(south, 5) AS albers_lat FROM its",
    "pluck_asset_href": "SELECT item_id, item_id || '.tif' AS href FROM its",
    "explode_assets": "SELECT item_id, 'image' AS asset, item_id || '.tif' AS href FROM its UNION ALL SELECT item_id, 'thumb', item_id || '.png' FROM its",
    "json_props_get": "SELECT event_id, json_extract_string(props, '$.k')::INT AS k, coalesce(json_extract_string(props, '$.absent'), 'none') AS absent FROM events",
    "array_slice_concat": "SELECT vec_id, 9 AS n, embedding[1]::DOUBLE AS first, embedding[6]::DOUBLE AS sixth, 1::DOUBLE AS last FROM embeddings",
    "head_and_more": "SELECT ordinal, url, greatest((SELECT count(*) FROM inv) - 10, 0) AS more FROM inv ORDER BY ordinal LIMIT 10",
    "throughput_report": "SELECT fresh, round(fresh / 90.0::DOUBLE, 1) AS rate, fresh - cached AS delta, round(fresh / 650.0::DOUBLE / 60.0::DOUBLE, 2) AS minutes FROM summed",
    "links_by_rel": "SELECT CASE WHEN ordinal % 1000 = 0 THEN 'child' ELSE 'item' END AS rel, count(*) AS n FROM inv GROUP BY 1",
    "lines_written_and_read": "SELECT url FROM inv",
    "checks_written_and_read": "SELECT url, is_geotiff, is_cog, coalesce(epsg, 0) AS epsg, coalesce(height, 0) AS height, coalesce(bounds[3], 0) AS \"right\", coalesce(len(transform), -1)::INT AS terms FROM checks",
    "report_written_and_read": "SELECT * FROM report",
    "access_written_and_read": "SELECT url, coalesce(CASE WHEN failure IS NULL THEN status END, -1) AS status_code, coalesce(status = 200, false) AND failure IS NULL AS accessible, CASE WHEN failure IS NOT NULL THEN failure WHEN status = 200 THEN '' ELSE coalesce(reason, '') END AS error, '2026-01-01T00:00:00Z' AS last_checked FROM probes",
    "documents_written_and_read": "SELECT 'area-' || area_id AS item_id, name, round(west, 6) AS west, (SELECT count(*) FROM areas) AS written, (SELECT count(*) FROM areas) AS counted FROM areas",
    "json_lines_written_and_read": f"SELECT item_id AS id, '{schema.COLLECTION_ID}' AS collection, datetime FROM resolved WHERE status = 'built'",
    "collection_written_and_read": "SELECT 'area-' || area_id AS id, name FROM areas",
    "ledger_appended": "SELECT fresh, cached, CASE WHEN cached > 0 AND fresh < 0.9 * cached THEN 2 WHEN new > 0 OR deleted > 0 THEN 1 ELSE 0 END AS exit_code, unnest([1, 2]) AS run FROM summed",
    "saved_search": f"SELECT item_id, datetime FROM its WHERE {_BOX} AND {_TIME}",
    "object_listing": "SELECT url FROM inv WHERE NOT contains(url, '(')",
    "catalog_tree_nodes": f"""SELECT '{fx.TREE}/catalog.json' AS href, 0 AS depth UNION ALL SELECT '{fx.TREE}/r' || r_regionkey || '/catalog.json', 1 FROM region
  UNION ALL SELECT '{fx.TREE}/n' || n_nationkey || '/catalog.json', 2 FROM nation UNION ALL SELECT '{fx.TREE}/c' || c_custkey || '/catalog.json', 3 FROM customer UNION ALL SELECT '{fx.TREE}/o' || o_orderkey || '/catalog.json', 4 FROM orders""",
    "catalog_tree_items": f"SELECT '{fx.TREE}/o' || o_orderkey || '/' || o_orderkey || '.json' AS href, '{fx.TREE}/o' || o_orderkey || '/catalog.json' AS parent, 5 AS depth FROM orders",
    "catalog_tree_back_links": f"SELECT '{fx.TREE}/o' || o_orderkey || '/catalog.json' AS source, '{fx.TREE}/catalog.json' AS target FROM orders",
    "head_probes": "SELECT url, CASE WHEN event_id % 7 = 0 THEN -1 WHEN event_id % 3 = 0 THEN 404 ELSE 200 END AS status_code, event_id % 7 <> 0 AND event_id % 3 <> 0 AS accessible, CASE WHEN event_id % 7 = 0 THEN 'timed out' WHEN event_id % 3 = 0 THEN 'Not Found' ELSE '' END AS error, 'now' AS last_checked FROM probes",
    "raster_header_rows": f"SELECT url, n % 5 <> 0 AS is_geotiff, n % 5 <> 0 AND n % 2 = 0 AS is_cog, CASE WHEN n % 5 <> 0 THEN 26910 ELSE 0 END AS epsg, CASE WHEN n % 5 <> 0 THEN 2 * n ELSE 0 END::INT AS width, CASE WHEN n % 5 <> 0 THEN 6 ELSE -1 END AS terms, CASE WHEN n % 5 <> 0 THEN n ELSE 0 END::DOUBLE AS \"right\" FROM (SELECT url, length(replace({_FIX}, ' ', '%20')) AS n FROM inv)",
    "probe_texts": "SELECT url, ordinal % 3 <> 2 AS is_geotiff, ordinal % 3 = 0 AS is_cog FROM inv",
    "area_features": "SELECT area_id, name, 'Polygon' AS shape, round(east, 6) AS x, round(north, 6) AS y, 5 AS points FROM areas",
    "bounds_service_rows": "SELECT url, event_id::DOUBLE AS \"left\", event_id + 1::DOUBLE AS \"right\" FROM probes WHERE event_id % 4 <> 0",
    "publish_plan": "SELECT CASE WHEN p AND NOT n THEN 'delete' WHEN n AND NOT p THEN 'add' WHEN doc_id % 5 = 0 THEN 'update' ELSE 'keep' END AS action, count(*) AS n FROM (SELECT doc_id, doc_id % 3 <> 1 AS n, doc_id % 4 <> 2 AS p FROM local_) WHERE n OR p GROUP BY 1",
    "publish_upsert": f"SELECT id, CASE WHEN doc_id % 3 = 1 AND doc_id % 5 = 0 THEN 'old' ELSE {_BODY} END AS body FROM local_ WHERE doc_id % 3 <> 1 OR doc_id % 4 <> 2",
    "published_catalog": f"SELECT id, {_BODY} AS body FROM local_ WHERE doc_id % 3 <> 1",
    "qa_of_documents": "SELECT doc_id::VARCHAR AS name, false AS missing, concat_ws(',', CASE WHEN doc_id % 10 = 3 AND lang IS NOT NULL THEN 'datetime' END, CASE WHEN doc_id % 6 = 5 THEN 'asset_count' END) AS differences FROM documents",
    "error_texts": "SELECT doc_id, 'STAC validation error: ' || substring(text, 1, 100) AS error, strftime(make_timestamp((1700000000 + doc_id) * 1000000), '%Y%m%d_%H%M%S') || '_build.log' AS log FROM documents",
    "listing_windows": "SELECT 1700006400 + (ordinal % 5) * 86400 AS day, count(*) AS urls FROM inv GROUP BY 1",
    "stream_incremental_items": "SELECT ordinal, item_id, status FROM resolved",
}

SQL: dict[str, str] = {name: _with(body) for name, body in {**_BODIES, **spatial.BODIES, **exchange.BODIES, "store_search_polygon": _BODIES["search_polygon"]}.items()}
