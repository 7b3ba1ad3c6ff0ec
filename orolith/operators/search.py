"""Search over items by collection, box, polygon and time, and spatial joins."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from orolith.functions import geo, rings
from orolith.operators import geometry

BOX = ("west", "south", "east", "north")


def with_box(items: DataFrame, bbox: str = "bbox") -> DataFrame:
    """Adds the box as four columns, which Parquet statistics can prune once items are stored sorted by them."""
    return items.withColumns({name: F.element_at(bbox, k) for k, name in enumerate(BOX, 1)})


def in_box(items: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Items whose box shares a point with the given one. Plain comparisons, so scans push them down."""
    return items.where((F.col("east") >= west) & (F.col("west") <= east) & (F.col("north") >= south) & (F.col("south") <= north))


def in_interval(items: DataFrame, interval: str) -> DataFrame:
    """Items of a closed interval start/end in RFC 3339 or dates; .. or nothing leaves an end open.

    Placeholder dates take part like others.
    """
    start, _, end = interval.partition("/")
    rows = items
    if start not in ("", ".."):
        rows = rows.where(F.to_timestamp("datetime") >= F.to_timestamp(F.lit(start)))
    if (end or start) not in ("", ".."):
        rows = rows.where(F.to_timestamp("datetime") <= F.to_timestamp(F.lit(end or start)))
    return rows


def _rings(polygon: dict) -> list[list[list[list[float]]]]:
    return [polygon["coordinates"]] if polygon["type"] == "Polygon" else polygon["coordinates"]


def _points(coordinates: list) -> list[list[float]]:
    return [coordinates] if coordinates and not isinstance(coordinates[0], list | tuple) else [p for part in coordinates for p in _points(part)]


def envelope(geometry: dict) -> list[float]:
    """The box around a GeoJSON geometry."""
    points = _points(geometry["coordinates"])
    return [min(p[0] for p in points), min(p[1] for p in points), max(p[0] for p in points), max(p[1] for p in points)]


def in_polygon(items: DataFrame, polygon: dict) -> DataFrame:
    """Items whose box meets a GeoJSON Polygon or MultiPolygon: first by its envelope, then exactly, edges included."""
    shapes = _rings(polygon)
    points = [p for rings in shapes for p in rings[0]]
    near = in_box(items, min(p[0] for p in points), min(p[1] for p in points), max(p[0] for p in points), max(p[1] for p in points))
    # a row of its own, so that an outline of many points is data and no part of the plan
    outline = items.sparkSession.createDataFrame([([[[[float(x), float(y)] for x, y, *_ in ring] for ring in rings] for rings in shapes],)], "_shapes array<array<array<array<double>>>>")
    meets = F.exists("_shapes", lambda rings: geo.polygon_meets_box(rings, *(F.col(c) for c in BOX)))
    return near.join(F.broadcast(outline), meets, "left_semi")


def search(items: DataFrame, collection: str | None = None, bbox: list[float] | None = None, intersects: dict | None = None, interval: str | None = None, datetime_unknown: bool | None = None) -> DataFrame:
    """All conditions that are given, together. Results are complete; page() cuts them."""
    rows = items
    if collection is not None:
        rows = rows.where(F.col("collection") == collection)
    if bbox is not None:
        rows = in_box(rows, *bbox)
    if interval is not None:
        rows = in_interval(rows, interval)
    if datetime_unknown is not None:
        rows = rows.where(F.coalesce("datetime_unknown", F.lit(False)) == datetime_unknown)
    return in_geometry(rows, intersects) if intersects is not None else rows


def in_geometry(items: DataFrame, asked: dict) -> DataFrame:
    """Items that share a point with a GeoJSON geometry: by their own geometry where they have that column (as text), else by their box."""
    if "geometry" not in items.columns and asked["type"] in ("Polygon", "MultiPolygon"):
        return in_polygon(items, asked)
    near = in_box(items, *envelope(asked))
    if "geometry" in items.columns:
        return geometry.meeting(near, asked)
    boxed = near.withColumn("geometry", F.to_json(geo.box_polygon(F.array(*BOX))))
    return geometry.meeting(boxed, asked).drop("geometry")


def page(items: DataFrame, limit: int, offset: int = 0, key: str = "item_id") -> DataFrame:
    return items.orderBy(key).offset(offset).limit(limit)


@dataclass
class Page:
    """The rows of a page, and the token that asks for the next one; None after the last page."""

    rows: list[Row]
    token: str | None


#: Newest first, then by id.
NEWEST = (("datetime", "desc"), ("item_id", "asc"))


def _tie(items: DataFrame) -> Column:
    """A hash of the whole row: rows that agree in all keys keep one order between runs."""
    return F.xxhash64(*[F.col(c) for c in items.columns])


def _after(order: list[tuple[str, str]], last: list) -> Column:
    """Rows at or behind a place in the order. Nulls come last in either direction. Comparisons of columns with literals only, so scans prune by them."""
    places, same = F.lit(False), F.lit(True)
    for (name, way), value in zip(order, last, strict=True):
        c = F.col(name)
        if value is not None:
            behind = (c > F.lit(value) if way == "asc" else c < F.lit(value)) | c.isNull()
            places = places | (same & behind)
        same = same & c.eqNullSafe(F.lit(value))
    return places | same


def keyset_page(items: DataFrame, limit: int, token: str | None = None, order: tuple[tuple[str, str], ...] = NEWEST) -> Page:
    """The next page of items in a composite order of text, whole or boolean columns, by a token that names the place of the last row before it.

    A page costs a filter and a top-limit, no matter how far in it lies, and items that come or go elsewhere don't move it. Rows that agree in all keys are ordered by a hash
    of the whole row; of rows that agree in everything the token counts those given already, so every row comes once. A token of another order is refused.
    """
    if limit < 1:
        raise ValueError("a page has at least one row")
    keys = [*order, ("_tie", "asc")]
    rows, seen = items.withColumn("_tie", _tie(items)), 0
    if token is not None:
        try:
            asked, last, seen = json.loads(base64.urlsafe_b64decode(token.encode()))
        except ValueError as wrong:
            raise ValueError("not a token of a page") from wrong
        if asked != [list(k) for k in order]:
            raise ValueError("the token belongs to another order")
        rows = rows.where(_after(keys, last))
    by = [F.col(name).asc_nulls_last() if way == "asc" else F.col(name).desc_nulls_last() for name, way in keys]
    place = lambda r: [r[name] for name, _ in keys]
    found = rows.orderBy(*by).limit(seen + limit + 1).collect()
    # those given already are the first ones, since they lie at the token's own place; some may be gone since
    found = found[sum(place(r) == last for r in found[:seen]) if seen else 0 :][: limit + 1]
    given = found[:limit]
    if len(found) <= limit:
        return Page([Row(**{c: r[c] for c in items.columns}) for r in given], None)
    end = place(given[-1])
    count = sum(place(r) == end for r in given) + (seen if token is not None and end == last else 0)
    text = json.dumps([[list(k) for k in order], end, count], separators=(",", ":"))
    return Page([Row(**{c: r[c] for c in items.columns}) for r in given], base64.urlsafe_b64encode(text.encode()).decode())


def pages(items: DataFrame, limit: int, order: tuple[tuple[str, str], ...] = NEWEST) -> Iterator[Page]:
    """All pages one after the other, each by the token of the one before."""
    token = None
    while True:
        got = keyset_page(items, limit, token, order)
        yield got
        token = got.token
        if token is None:
            return


def area_join(items: DataFrame, areas: DataFrame, cell: float = 1.0) -> DataFrame:
    """Pairs (item_id, area_id) of boxes and areas (area_id, shapes: MultiPolygon coordinates) that meet, each pair once even where an item meets several parts."""
    parts = areas.select("area_id", F.explode("shapes").alias("rings"))
    return polygon_join(items, parts, cell).distinct()


def named_areas(areas: DataFrame, name: str) -> DataFrame:
    """Areas of interest of a name, brought to lon/lat where they have a projection code: by their rings, as shapes and the box around these, where they have rings, else by their box."""
    rows = areas.where(F.col("name") == name)
    if "epsg" in rows.columns and "rings" in rows.columns:
        rows = rings.add_lonlat_shapes(rows, "rings", "epsg", "shapes")
        box = geo.ring_box(F.flatten(F.transform("shapes", lambda polygon: polygon[0])))
        return rows.withColumns({c: F.element_at(box, k) for k, c in enumerate(BOX, 1)})
    if "epsg" in rows.columns:
        rows = geo.add_bounds(rows.withColumn("_native", F.array(*BOX)), "_native", "epsg", "_box")
        rows = rows.withColumns({c: F.element_at("_box", k) for k, c in enumerate(BOX, 1)}).drop("_box", "_native")
    return rows


def _grid_pairs(items: DataFrame, areas: DataFrame, cell: float, carried: tuple[str, ...] = ()) -> DataFrame:
    """Meeting pairs (item_id, area_id, the item's box, carried columns of areas), each once, by an equi-join over grid cells."""
    left = items.select("item_id", *BOX).withColumn("c", F.explode(geo.cells(*(F.col(c) for c in BOX), cell))).select("*", "c.cx", "c.cy").drop("c")
    right = areas.select("area_id", *[F.col(c).alias(f"_{c}") for c in (*BOX, *carried)]).withColumn("c", F.explode(geo.cells(*(F.col(f"_{c}") for c in BOX), cell))).select("*", F.col("c.cx").alias("_cx"), F.col("c.cy").alias("_cy")).drop("c")
    corner = (F.col("cx") == F.floor(F.greatest("west", "_west") / cell)) & (F.col("cy") == F.floor(F.greatest("south", "_south") / cell))
    meet = geo.boxes_meet(*(F.col(c) for c in BOX), *(F.col(f"_{c}") for c in BOX))
    return left.join(right, (F.col("cx") == F.col("_cx")) & (F.col("cy") == F.col("_cy")) & corner & meet).select("item_id", "area_id", *BOX, *[F.col(f"_{c}").alias(c) for c in carried])


def spatial_join(items: DataFrame, areas: DataFrame, cell: float = 1.0) -> DataFrame:
    """Pairs (item_id, area_id) of boxes that meet, by an equi-join over grid cells.

    A pair that shares several cells counts only in the one that holds the lower left corner of
    its overlap, so nothing is made distinct. cell: degrees; about the size of usual boxes.
    """
    return _grid_pairs(items, areas, cell).select("item_id", "area_id")


def polygon_join(items: DataFrame, areas: DataFrame, cell: float = 1.0) -> DataFrame:
    """Pairs (item_id, area_id) of boxes and polygons (area_id, rings) that meet: the grid join of boxes, then the exact test.

    Rows that repeat an id are rows of their own, as in spatial_join().
    """
    boxed = areas.withColumn("_b", geo.ring_box(F.element_at("rings", 1))).withColumns({c: F.element_at("_b", k) for k, c in enumerate(BOX, 1)})
    pairs = _grid_pairs(items, boxed, cell, ("rings",))
    return pairs.where(geo.polygon_meets_box(F.col("rings"), *(F.col(c) for c in BOX))).select("item_id", "area_id")


def asset_hrefs(items: DataFrame) -> DataFrame:
    """(item_id, href) of image assets of item structs."""
    return items.select(F.col("item.id").alias("item_id"), F.col("item.assets.image.href").alias("href"))


def all_assets(items: DataFrame) -> DataFrame:
    """(item_id, asset, href) of every asset of parsed items."""
    return items.select(F.col("item.id").alias("item_id"), F.explode("item.assets").alias("asset", "a")).select("item_id", "asset", F.col("a.href").alias("href"))
