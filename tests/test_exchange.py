"""Raster headers, the transactional sink, page tokens and reprojected rings."""

import json
import math
import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orolith.functions import geo, rings
from orolith.operators import search
from orolith.plans import pipeline
from orolith.plans.exchange import GOOD, LAYOUTS, tiff_bytes
from orolith.sources import documents, tiff, writers

TERMS = [2.0, 0.0, 300000.0, 0.0, -2.0, 5500000.0]


def reader(data):
    return lambda offset, length: data[offset : offset + length]


def test_headers_of_real_files(spark, tmp_path):
    for layout in LAYOUTS:
        (tmp_path / f"{layout}.tif").write_bytes(tiff_bytes(1500, 700, 26910, TERMS, layout))
    (tmp_path / "cut.tif").write_bytes(tiff_bytes(1500, 700, 26910, TERMS, "cog")[:60])
    (tmp_path / "text.tif").write_bytes(b"II is no raster")
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.tif")
    rows = {r["path"].rsplit("/", 1)[1][:-4]: r for r in tiff.describe(tiff.file_headers(files), "path").collect()}
    assert {k for k, r in rows.items() if not r["is_geotiff"]} == {"cut", "text"}
    assert {k for k, r in rows.items() if r["is_cog"]} == set(GOOD)
    for layout in LAYOUTS:
        r = rows[layout]
        assert (r["epsg"], r["height"], r["width"]) == (26910, 700, 1500)
        assert r["transform"] == TERMS and r["bounds"] == [300000.0, 5498600.0, 303000.0, 5500000.0]
    assert rows["text"]["transform"] is None and rows["text"]["bounds"] is None and rows["text"]["epsg"] is None


def test_headers_without_georeference(spark):
    data = [("plain", tiff_bytes(40, 30, None, None, "strips")), ("code", tiff_bytes(40, 30, 32767, None, "points")), ("none", None), ("empty", b"")]
    rows = {r["k"]: r for r in tiff.describe(tiff.file_headers(spark.createDataFrame(data, "k string, c binary"), "k", "c"), "k").collect()}
    assert rows["plain"]["transform"] == [1.0, 0.0, 0.0, 0.0, 1.0, 0.0] and rows["plain"]["bounds"] == [0.0, 30.0, 40.0, 0.0]
    assert rows["plain"]["is_cog"]  # small images need no tiles
    assert rows["code"]["epsg"] is None and rows["code"]["transform"] == [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    assert not rows["none"]["is_geotiff"] and not rows["empty"]["is_geotiff"]


def test_turned_raster_has_the_box_of_its_corners(spark):
    data = [("t", tiff_bytes(10, 20, 3005, [0.6, 0.8, 100.0, 0.8, -0.6, 200.0], "late"))]
    r = tiff.describe(tiff.file_headers(spark.createDataFrame(data, "k string, c binary"), "k", "c"), "k").first()
    corners = [(100 + 0.6 * i + 0.8 * j, 200 + 0.8 * i - 0.6 * j) for i in (0, 10) for j in (0, 20)]
    assert r["bounds"] == pytest.approx([min(x for x, _ in corners), min(y for _, y in corners), max(x for x, _ in corners), max(y for _, y in corners)])


def test_damaged_bytes_raise_in_bounds():
    whole = tiff_bytes(1500, 700, 26910, TERMS, "big")
    tiff.decode(reader(whole))
    for end in range(0, len(whole) - 1, 7):
        with pytest.raises(ValueError):
            tiff.decode(reader(whole[:end]))
    rng = random.Random(3)
    for _ in range(300):
        bad = bytearray(whole)
        for _ in range(4):
            bad[rng.randrange(len(bad))] = rng.randrange(256)
        tiff._header_or_none(reader(bytes(bad)))  # any bytes end, in a header or in none
    circle = bytearray(tiff_bytes(10, 10, None, None, "strips"))
    at = int.from_bytes(circle[4:8], "little")
    n = int.from_bytes(circle[at : at + 2], "little")
    circle[at + 2 + n * 12 : at + 6 + n * 12] = circle[4:8]
    with pytest.raises(ValueError, match="circle"):
        tiff.decode(reader(bytes(circle)))


def test_remote_headers_take_few_ranges(spark, tmp_path):
    for layout in LAYOUTS:
        (tmp_path / layout).write_bytes(tiff_bytes(1500, 700, 26910, TERMS, layout))
    root = str(tmp_path)

    def fetch(url, offset, length):
        with Path(root, "asked").open("a") as log:
            log.write(f"{url}\n")
        with Path(root, url).open("rb") as file:  # an address without a file raises
            file.seek(offset)
            return file.read(length)

    urls = spark.createDataFrame([(x,) for x in (*LAYOUTS, "absent")], "url string")
    rows = {r["url"]: r for r in tiff.describe(tiff.remote_headers(urls, fetch, partitions=2)).collect()}
    assert not rows["absent"]["is_geotiff"] and all(rows[x]["is_geotiff"] for x in LAYOUTS)
    assert {x for x in LAYOUTS if rows[x]["is_cog"]} == set(GOOD)
    assert (tmp_path / "asked").read_text().split().count("cog") == 1


def bodies(path):
    return {p.stem: p.read_text() for p in Path(path).glob("items/*/*.json")}


def test_documents_replace_and_come_before_the_collection(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    rows = spark.range(50).select(F.col("id").cast("string").alias("item_id"), F.concat(F.lit("b"), "id").alias("body"))
    documents.write_documents(rows.repartition(7), path, "first")
    assert bodies(path) == {str(k): f"b{k}\n" for k in range(50)} and Path(path, "collection.json").read_text() == "first\n"
    documents.write_documents(rows.where("id < 3").withColumn("body", F.when(F.col("item_id") != "1", F.col("body"))), path)
    assert bodies(path) == {"0": "b0\n", "1": "\n", "2": "b2\n"} and Path(path, "collection.json").read_text() == "first\n"
    documents.write_documents(rows.limit(0), path, "empty")
    assert bodies(path) == {} and Path(path, "items").is_dir()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["catalog"]


def test_a_failed_task_leaves_everything_as_it_was(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    rows = spark.range(40).select(F.col("id").cast("string").alias("item_id"), F.lit("old").alias("body"))
    documents.write_documents(rows, path, "old")
    last = F.col("item_id") == "33"
    named, raised = F.when(last, F.lit("a/b")).otherwise(F.col("item_id")), F.when(last, F.raise_error(F.lit("no body")).cast("string")).otherwise(F.lit("new"))
    for item, body in ((named, F.lit("new")), (F.col("item_id"), raised)):
        broken = rows.repartition(5).select(item.alias("item_id"), body.alias("body"))
        with pytest.raises(Exception):  # noqa: B017 - whatever Spark wraps it in
            documents.write_documents(broken, path, "new")
        assert set(bodies(path).values()) == {"old\n"} and len(bodies(path)) == 40 and Path(path, "collection.json").read_text() == "old\n"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["catalog"]


def test_sink_drops_folders_of_lost_attempts(tmp_path):
    Path(tmp_path, "p").mkdir()
    sink = documents.DocumentWriter(f"{tmp_path}/c", f"{tmp_path}/p", None)
    lost, good = sink.write(iter([{"item_id": "a", "body": "lost"}])), sink.write(iter([{"item_id": "a", "body": "good"}]))
    assert (lost.documents, good.documents) == (1, 1)
    sink.commit([good, None])
    assert bodies(f"{tmp_path}/c") == {"a": "good\n"}


def test_sink_refuses(spark):
    rows = spark.createDataFrame([("a", "b")], "item_id string, body string")
    with pytest.raises(ValueError, match="overwrite"):
        documents.DocumentSink({"path": "/tmp/x", "pending": "/tmp/y"}).writer(rows.schema, False)


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]"])
def test_cluster_takes_local_paths_in_shared_folders(spark, tmp_path, monkeypatch, master):
    rows = spark.createDataFrame([("a", "b")], "item_id string, body string")
    shared = f"{spark.conf.get('spark.checkpoint.dir')}/{tmp_path.name}"
    monkeypatch.setattr(spark.sparkContext, "master", master)
    documents.write_documents(rows, f"{shared}/sink", "c")
    assert bodies(f"{shared}/sink") == {"a": "b\n"}
    assert writers.export_documents(rows, f"file://{shared}/files") == 1 and Path(shared, "files/a.json").read_text() == "b\n"
    for write in (documents.write_documents, writers.export_documents):
        for path in (f"{tmp_path}/own", f"{shared}/../../own", f"file://{spark.conf.get('spark.checkpoint.dir')}-not/x"):
            with pytest.raises(ValueError, match="executors share"):
                write(rows, path)


@pytest.mark.parametrize("limit", [1, 3, 7, 100])
def test_pages_give_each_row_once(spark, limit):
    rng = random.Random(limit)
    data = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.randrange(4)) for _ in range(30)]
    items = spark.createDataFrame(data, "datetime string, item_id int, other int").repartition(3)
    got = [tuple(r) for p in search.pages(items, limit) for r in p.rows]
    assert sorted(got, key=str) == sorted(data, key=str)
    place = lambda r: (r[0] is None, -ord(r[0] or "a"), r[1] is None, r[1] or 0)
    assert [place(r) for r in got] == sorted(place(r) for r in got)


def test_page_tokens_hold_their_place(spark):
    items = spark.range(20).select(F.col("id").alias("item_id"), F.lit("d").alias("datetime"))
    first = search.keyset_page(items, 5)
    assert [r["item_id"] for r in first.rows] == [0, 1, 2, 3, 4]
    fewer = items.where("item_id not in (1, 4, 6)")  # also the row that the token names
    assert [r["item_id"] for r in search.keyset_page(fewer, 5, first.token).rows] == [5, 7, 8, 9, 10]
    assert search.keyset_page(items.limit(0), 5) == search.Page([], None)
    assert search.keyset_page(items, 20).token is None
    for wrong in ("?", "e30=", ""):
        with pytest.raises(ValueError):
            search.keyset_page(items, 5, wrong)
    with pytest.raises(ValueError, match="order"):
        search.keyset_page(items, 5, first.token, (("item_id", "asc"),))
    with pytest.raises(ValueError, match="at least one"):
        search.keyset_page(items, 0)


RING = [[300000.0, 5400000.0], [700000.0, 5450000.0], [650000.0, 6000000.0], [310000.0, 5900000.0], [300000.0, 5400000.0]]
#: Where the provincial projection puts its origin, from the zones' northings.
ALBERS_SHIFT = 4_800_000.0
HOLE = [[400000.0, 5600000.0], [400000.0, 5700000.0], [500000.0, 5700000.0], [400000.0, 5600000.0]]


def native(spark, points, epsg):
    """Points brought back by the forward projection."""
    rows = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    x, y = geo.lonlat_to_albers(F.col("x"), F.col("y")) if epsg == 3005 else geo.lonlat_to_utm(F.col("x"), F.col("y"), geo.central_meridian(F.lit(epsg)))
    return [(r["a"], r["b"]) for r in rows.select("i", x.alias("a"), y.alias("b")).orderBy("i").collect()]


def off_edges(p, ring):
    """The distance of a point to a ring's edges."""
    best = math.inf
    for a, b in zip(ring, ring[1:], strict=False):
        d = (b[0] - a[0], b[1] - a[1])
        t = max(0.0, min(1.0, ((p[0] - a[0]) * d[0] + (p[1] - a[1]) * d[1]) / (d[0] ** 2 + d[1] ** 2)))
        best = min(best, math.hypot(p[0] - a[0] - t * d[0], p[1] - a[1] - t * d[1]))
    return best


@pytest.mark.parametrize("epsg", [26910, 3157, 3005])
def test_rings_follow_their_edges(spark, epsg):
    sources = [[[x, y - (ALBERS_SHIFT if epsg == 3005 else 0.0)] for x, y in ring] for ring in (RING, HOLE)]
    rows = spark.createDataFrame([(epsg, sources)], "epsg int, rings array<array<array<double>>>")
    (polygon,) = rings.add_lonlat_shapes(rows, "rings", "epsg", "shapes", tolerance=1e-5).first()["shapes"]
    assert len(polygon) == 2
    for ring, source in zip(polygon, sources, strict=True):
        assert ring[0] == ring[-1] and len(ring) > len(source)
        back = native(spark, ring, epsg)
        assert max(off_edges(p, source) for p in back) < 0.01
        assert all(min(math.hypot(p[0] - v[0], p[1] - v[1]) for p in back) < 0.01 for v in source)
        # points between two vertices of the result stay within the tolerance, about a metre
        middle = [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(ring, ring[1:], strict=False)]
        assert max(off_edges(p, source) for p in native(spark, middle, epsg)) < 1.5


def area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))) / 2


@pytest.mark.parametrize(("epsg", "sign"), [(32601, -1), (32660, 1)])
def test_rings_are_cut_at_the_antimeridian(spark, epsg, sign):
    x = 300000.0 if sign < 0 else 700000.0
    ring = [[x - 100000, 6500000.0], [x + 100000, 6500000.0], [x + 100000, 6600000.0], [x - 100000, 6600000.0], [x - 100000, 6500000.0]]
    rows = spark.createDataFrame([(epsg, [ring])], "epsg int, rings array<array<array<double>>>")
    shapes = rings.add_lonlat_shapes(rows, "rings", "epsg", "shapes", tolerance=1e-5).first()["shapes"]
    assert len(shapes) == 2
    lons = [[p[0] for p in s[0]] for s in shapes]
    assert all(-180 <= v <= 180 for part in lons for v in part)
    assert sorted((min(part) > 0) for part in lons) == [False, True] and {180.0, -180.0} <= {v for part in lons for v in part}
    assert all(s[0][0] == s[0][-1] for s in shapes)
    whole = sum(area(s[0]) for s in shapes)
    joined = [[v + (-360 * (v > 0) if sign < 0 else 360 * (v < 0)) for v in part] for part in lons]
    assert max(map(max, joined)) - min(map(min, joined)) < 5 and whole == pytest.approx(200 * 100 / (111.4 * math.cos(math.radians(59))) / 111.4, rel=0.02)


def test_rings_without_a_result(spark):
    data = [(1, 9999, [RING]), (2, 26910, None), (3, 26910, [RING[:3]]), (4, None, [RING]), (5, 26910, []), (6, 4326, [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]])]
    rows = spark.createDataFrame(data, "id int, epsg int, rings array<array<array<double>>>")
    got = {r["id"]: r["shapes"] for r in rings.add_lonlat_shapes(rows, "rings", "epsg", "shapes").collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: None, 6: [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]}


def test_named_areas_by_rings(spark):
    areas = spark.createDataFrame([(1, "a", 26910, [RING]), (2, "b", 26910, [RING])], "area_id int, name string, epsg int, rings array<array<array<double>>>")
    area_ = search.named_areas(areas, "a")
    row = area_.first()
    assert -126 < row["west"] < row["east"] < -119 and 48 < row["south"] < row["north"] < 55
    inside, outside = ((row["west"] + row["east"]) / 2, (row["south"] + row["north"]) / 2), (row["west"], row["north"])
    boxes = [(k, x, y, x + 1e-3, y + 1e-3) for k, (x, y) in (("in", inside), ("corner", outside))]
    items = spark.createDataFrame(boxes, "item_id string, west double, south double, east double, north double")
    assert [tuple(r) for r in search.area_join(items, area_).collect()] == [("in", 1)]
    assert json.dumps(row["shapes"])


def test_build_once_equals_build(spark, tmp_path):
    urls = spark.createDataFrame([(k, f"https://objects.example.org/tiles/a/dem/t_{k}_utm9_{20200101 + k}.tif") for k in range(9)], "ordinal long, url string")
    checks = spark.createDataFrame(
        [(k, f"https://objects.example.org/tiles/a/dem/t_{k}_utm9_{20200101 + k}.tif", k % 4 != 0, True, 26909, 10, 10, [1.0, 0.0, 5e5, 0.0, -1.0, 5.5e6], [5e5, 5.49999e6, 5.0001e5, 5.5e6]) for k in range(7)],
        "ordinal long, url string, is_geotiff boolean, is_cog boolean, epsg int, height int, width int, transform array<double>, bounds array<double>",
    )
    links = spark.createDataFrame([], "rel string, href string, type string")
    plain = pipeline.build(urls, checks, links)
    run, counts = pipeline.build_once(urls, checks, links, f"{tmp_path}/rows")
    assert counts == {k: v for k, v in plain.status.first().asDict().items() if k in counts} and counts["detected"] == 9 and counts["built"] > 0
    for part in ("rows", "documents", "links"):
        assert sorted(map(str, getattr(run, part).collect())) == sorted(map(str, getattr(plain, part).collect()))
    none, counts = pipeline.build_once(urls.limit(0), checks, links, f"{tmp_path}/none")
    assert set(counts.values()) == {0} and none.documents.isEmpty()


def test_headers_come_in_small_batches():
    class Rows:
        def mapInArrow(self, run, schema):
            return run

    run = tiff._mapped(Rows(), "url", lambda b: (reader(b"") for _ in range(b.num_rows)))
    found = list(run(iter([pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(1000)])], ["url"])])))
    assert max(b.num_rows for b in found) <= 256 and [u for b in found for u in b.column(0).to_pylist()] == [str(k) for k in range(1000)]
