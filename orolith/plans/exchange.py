"""Queries of raster headers, the transactional document sink, page tokens and reprojected areas, and their DuckDB SQL."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith.functions import rings
from orolith.operators import search
from orolith.plans import fixtures as fx
from orolith.plans import pipeline
from orolith.plans.queries import _checks, _inventory, _items, _scratch, query
from orolith.sources import documents, tiff

#: Layouts of the rasters that rows are written as: cloud-optimized in both forms; in strips; the directory late; data in the wrong order; one level whose pixels are points.
LAYOUTS = ("cog", "big", "strips", "late", "upside_down", "points")
GOOD = ("cog", "big", "points")
PAGE, PAGES = 25, 3


def tiff_bytes(width: int, height: int, epsg: int | None, transform: list[float] | None, layout: str, block: int = 512) -> bytes:
    """A raster's header and directories; block offsets point behind them, where no data are."""
    big, order = layout == "big", ">" if layout in ("big", "late") else "<"
    word, counter, cell, wide = ("Q", "Q", 8, 16) if big else ("I", "H", 4, 4)
    levels = [(width, height)] + ([] if layout in ("strips", "points") else [(-(-width // 2), -(-height // 2)), (-(-width // 4), -(-height // 4))])
    body = bytearray((b"II" if order == "<" else b"MM") + (struct.pack(f"{order}HHHQ", 43, 8, 0, 0) if big else struct.pack(f"{order}HI", 42, 0)))
    if layout == "late":
        body += bytes(4000)
    link = 8 if big else 4
    data = 1 << 20
    starts = {k: data + (k if layout == "upside_down" else len(levels) - 1 - k) * (1 << 20) for k in range(len(levels))}
    for k, (w, h) in enumerate(levels):
        across, down = -(-w // block), -(-h // block)
        blocks = [starts[k] + i * 100 for i in range(h if layout == "strips" else across * down)]
        fields = [(254, wide, [1 if k else 0]), (256, 4, [w]), (257, 4, [h])]
        fields += [(273, wide, blocks)] if layout == "strips" else [(322, 3, [block]), (323, 3, [block]), (324, wide, blocks)]
        if k == 0 and transform is not None:
            a, b, c, d, e, f = transform
            half = 0.5 if layout == "points" else 0.0
            if layout == "late":
                fields.append((34264, 12, [a, b, 0.0, c, d, e, 0.0, f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]))
            else:
                fields += [(33550, 12, [a, -e, 0.0]), (33922, 12, [0.0, 0.0, 0.0, c + a * half, f + e * half, 0.0])]
        if k == 0:
            keys = [(1024, 0, 1, 1), (1025, 0, 1, 2 if layout == "points" else 1)] + ([(3072, 0, 1, epsg)] if epsg is not None else [])
            fields.append((34735, 3, [v for row in [(1, 1, 0, len(keys)), *keys] for v in row]))
        at = len(body)
        body[link : link + cell] = struct.pack(order + word, at)
        code = tiff.FIELD_TYPES
        packed = [(tag, kind, len(v), struct.pack(f"{order}{len(v)}{code[kind]}", *v)) for tag, kind, v in fields]
        later = at + struct.calcsize(f"={counter}") + len(packed) * (20 if big else 12) + cell
        table, extra = bytearray(struct.pack(order + counter, len(packed))), bytearray()
        for tag, kind, n, raw in packed:
            table += struct.pack(f"{order}HH{word}", tag, kind, n)
            if len(raw) <= cell:
                table += raw.ljust(cell, b"\0")
            else:
                table += struct.pack(order + word, later + len(extra))
                extra += raw
        link = at + len(table)
        body += table + bytes(cell) + extra
    return bytes(body)


def _files(s, d) -> DataFrame:
    """The checked rasters as files: text in the place of what can't be opened."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, tiff.SLICE):
                b = whole.slice(low, tiff.SLICE)
                rows = zip(*(c.to_pylist() for c in b.columns), strict=True)
                content = [tiff_bytes(w, h, e, t, k) if ok else u.encode() for u, ok, e, h, w, t, k in rows]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(content, pa.binary())], ["url", "content"])

    layout = F.element_at(F.array(*[F.lit(x) for x in LAYOUTS]), (F.col("ordinal") % len(LAYOUTS) + 1).cast("int"))
    rows = _checks(s, d).select(F.col("ordinal").cast("string").alias("url"), "is_geotiff", "epsg", "height", "width", "transform", layout.alias("layout"))
    return rows.mapInArrow(write, "url string, content binary")


@query
def tiff_headers(s, d):
    """Headers written from the rows of the raster cache, decoded again."""
    rows = tiff.describe(tiff.file_headers(_files(s, d), "url"))
    t = [F.round(F.coalesce(F.element_at("transform", k), F.lit(-1.0)), 6).alias(f"t{k}") for k in range(1, 7)]
    b = [F.round(F.coalesce(F.element_at("bounds", k), F.lit(-1.0)), 6).alias(f"b{k}") for k in range(1, 5)]
    return rows.select(F.col("url").cast("long").alias("ordinal"), "is_geotiff", "is_cog", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("epsg", "height", "width")], *t, *b)


@query
def tiff_layouts(s, d):
    """Counts of the layouts as column logic sees them."""
    rows = tiff.describe(tiff.file_headers(_files(s, d), "url"))
    return rows.groupBy("is_geotiff", "is_cog", F.coalesce("epsg", F.lit(-1)).alias("epsg")).agg(F.count("*").alias("n"))


@query
def documents_committed(s, d):
    """Two commits of the sink over one path; what is there is the second one's, whole."""
    path = _scratch(s, "documents")
    rows = fx.relation(s, d, fx.AREAS).select(F.concat(F.lit("area-"), F.col("area_id").cast("string")).alias("item_id"), F.to_json(F.struct("name", "west")).alias("body"), "area_id")
    documents.write_documents(rows, path, "{}")
    documents.write_documents(rows.where("area_id % 3 <> 0").repartition(4), path, '{"type":"Collection"}')
    name = F.regexp_extract(F.input_file_name(), r"([^/]*)\.json$", 1)
    read = s.read.text(f"{path}/items/*/*.json").select(name.alias("item_id"), F.from_json("value", "name string, west double").alias("b"))
    kind = s.read.text(f"{path}/collection.json").select(F.get_json_object("value", "$.type").alias("collection"))
    return read.join(kind).select("item_id", "b.name", F.round("b.west", 6).alias("west"), "collection")


@query
def search_by_tokens(s, d):
    """The first pages of all items, newest first, each by the token of the page before."""
    token, found = None, []
    for n in range(1, PAGES + 1):
        got = search.keyset_page(_items(s, d), PAGE, token)
        found += [(n, k, r["item_id"], r["datetime"]) for k, r in enumerate(got.rows, 1)]
        token = got.token
        if token is None:
            break
    return s.createDataFrame(found, "page int, place int, item_id string, datetime string")


@query
def footprints_reprojected(s, d):
    """Native footprints as lon/lat polygons: points, parts and the box around them."""
    at = lambda x, y: F.array(F.element_at("bounds", x), F.element_at("bounds", y))
    ring = F.array(at(1, 2), at(3, 2), at(3, 4), at(1, 4), at(1, 2))
    rows = _checks(s, d).where("bounds IS NOT NULL AND epsg IS NOT NULL").select("ordinal", "epsg", F.array(ring).alias("rings"))
    shapes = rings.add_lonlat_shapes(rows, "rings", "epsg", "shapes", tolerance=1e-5)
    outer = F.flatten(F.transform("shapes", lambda p: p[0]))
    xs, ys = F.transform(outer, lambda p: p[0]), F.transform(outer, lambda p: p[1])
    return shapes.select("ordinal", "epsg", F.size("shapes").alias("parts"), (F.size(outer) >= 5).alias("closed"), *[F.floor(v * 1000 + 0.5).alias(n) for v, n in ((F.array_min(xs), "west"), (F.array_min(ys), "south"), (F.array_max(xs), "east"), (F.array_max(ys), "north"))])


@query
def build_observed(s, d):
    """A build that resolves its rows once: observed counts beside those of the documents and of the report made from what was written."""
    links = s.createDataFrame([], "rel string, href string, type string")
    run, counts = pipeline.build_once(_inventory(s, d), _checks(s, d), links, _scratch(s, "rows"))
    made = run.documents.agg(F.count("*").alias("documents"))
    reported = run.report.agg(F.count("*").alias("reported"))
    return made.join(reported).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()], "documents", "reported")


_ORDINAL = "c.ordinal % 6 IN (" + ", ".join(str(LAYOUTS.index(x)) for x in GOOD) + ")"
_T = [f"CASE WHEN is_geotiff THEN round(coalesce(transform[{k}], {v}), 6) ELSE -1e0 END::DOUBLE AS t{k}" for k, v in enumerate(("1e0", "0e0", "0e0", "0e0", "1e0", "0e0"), 1)]
_B = [f"CASE WHEN is_geotiff THEN round(CASE WHEN transform IS NULL THEN {v} ELSE bounds[{k}] END, 6) ELSE -1e0 END::DOUBLE AS b{k}" for k, v in enumerate(("0e0", "height", "width", "0e0"), 1)]
_CODE = "CASE WHEN is_geotiff THEN coalesce(epsg, -1) ELSE -1 END AS epsg"
_CHECKS = fx.as_duckdb(fx.CHECKS)
BODIES: dict[str, str] = {
    "tiff_headers": f"SELECT ordinal, is_geotiff, is_geotiff AND {_ORDINAL} AS is_cog, {_CODE}, coalesce(height, -1) AS height, coalesce(width, -1) AS width, {', '.join(_T + _B)} FROM ({_CHECKS}) c",
    "tiff_layouts": f"SELECT is_geotiff, is_geotiff AND {_ORDINAL} AS is_cog, {_CODE}, count(*) AS n FROM ({_CHECKS}) c GROUP BY ALL",
    "build_observed": "SELECT *, built AS documents, built AS reported FROM (SELECT count(*) AS detected, " + ", ".join(f"count(*) FILTER (status = '{x}') AS {x}" for x in ("built", "no_cache", "unreadable", "bad_date", "needs_remote", "error")) + " FROM resolved)",
    "documents_committed": f"SELECT 'area-' || area_id AS item_id, name, round(west, 6) AS west, 'Collection' AS collection FROM ({fx.as_duckdb(fx.AREAS)}) a WHERE area_id % 3 <> 0",
    "search_by_tokens": f"SELECT ((n - 1) // {PAGE} + 1)::INT AS page, ((n - 1) % {PAGE} + 1)::INT AS place, item_id, datetime FROM (SELECT item_id, datetime, row_number() OVER (ORDER BY datetime DESC, item_id) AS n FROM its) WHERE n <= {PAGE * PAGES}",
}
