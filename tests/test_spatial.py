"""General geometries and the item store, against exact brute force."""

import json
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orolith.functions import curve
from orolith.operators import geometry, search
from orolith.sources import itemstore


def paths_of(g):
    c = g["coordinates"]
    return {"Point": lambda: [[c]], "MultiPoint": lambda: [[p] for p in c], "LineString": lambda: [c], "MultiLineString": lambda: c, "Polygon": lambda: c, "MultiPolygon": lambda: [r for p in c for r in p]}[g["type"]]()


def edges_of(g):
    return [(path[k], path[min(k + 1, len(path) - 1)]) for path in paths_of(g) for k in range(max(len(path) - 1, 1))]


def side(a, b, p):
    return Fraction(b[0] - a[0]) * Fraction(p[1] - a[1]) - Fraction(b[1] - a[1]) * Fraction(p[0] - a[0])


def on(a, b, p):
    return side(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def crossing(a, b, c, d):
    if on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b):
        return True
    return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0


def inside(g, p):
    if "Polygon" not in g["type"]:
        return False
    odd = False
    for a, b in edges_of(g):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < Fraction(b[0] - a[0]) * Fraction(p[1] - a[1]) / Fraction(b[1] - a[1]) + Fraction(a[0]):
            odd = not odd
    return odd


def meet(g, h):
    return any(crossing(*e, *f) for e in edges_of(g) for f in edges_of(h)) or any(inside(h, path[0]) for path in paths_of(g)) or any(inside(g, path[0]) for path in paths_of(h))


def made(rng):
    """A geometry on a coarse grid of halves, so that ends, edges and corners touch often."""
    x, y = rng.randint(-8, 8) / 2, rng.randint(-8, 8) / 2
    at = lambda r: [x + rng.randint(-r, r) / 2, y + rng.randint(-r, r) / 2]
    w, h = rng.randint(1, 7) / 2, rng.randint(1, 7) / 2
    ring = [[x, y], [x + w, y + rng.randint(0, 1) / 2], [x + w, y + h], [x, y + h], [x, y]]
    hole = [[x + w / 4, y + h / 2], [x + w / 2, y + h / 2], [x + w / 2, y + 3 * h / 4], [x + w / 4, y + h / 2]]
    kind = rng.choice(["Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "Polygon", "MultiPolygon"])
    far = [[[p[0] + 9, p[1]] for p in ring]]
    c = {"Point": lambda: at(3), "MultiPoint": lambda: [at(6) for _ in range(3)], "LineString": lambda: [at(6) for _ in range(rng.randint(2, 4))], "MultiLineString": lambda: [[at(6), at(6)], [at(2), at(2)]], "Polygon": lambda: [ring, hole] if rng.random() < 0.5 else [ring], "MultiPolygon": lambda: [[ring, hole], far]}[kind]()
    return {"type": kind, "coordinates": c}


@pytest.mark.parametrize("cell,seed", [(1.0, 1), (0.7, 2)])
def test_all_types_against_exact_arithmetic(spark, cell, seed):
    rng = random.Random(seed)
    left, right = [(f"i{k}", made(rng)) for k in range(60)], [(k, made(rng)) for k in range(60)]
    frame = lambda rows, key: spark.createDataFrame([(k, json.dumps(g)) for k, g in rows], f"{key}, geometry string")
    found = {tuple(r) for r in geometry.geometry_join(frame(left, "item string"), frame(right, "area long"), "item", "area", cell).collect()}
    wanted = {(i, k) for i, g in left for k, h in right if meet(g, h)}
    assert found == wanted and len(wanted) > 100


def test_odd_geometries_meet_nothing(spark):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]]}
    texts = [None, "", "{", '{"type":"Point"}', '{"type":"Point","coordinates":[]}', '{"type":"Point","coordinates":[1,null]}', '{"type":"LineString","coordinates":[]}', '{"type":"Circle","coordinates":[1,1]}', '{"type":"Point","coordinates":[1,1,99]}']
    items = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(texts)] + [(None, texts[-1]), ("i8", texts[-1])], "item_id string, geometry string")
    assert [r["item_id"] for r in geometry.meeting(items, square).collect()] == ["i8", "i8"]
    assert geometry.meeting(items.limit(0), square).count() == 0


def test_search_takes_any_geometry(spark):
    rows = [("a", "elevation", 0.0, 0.0, 1.0, 1.0), ("b", "elevation", 2.0, 2.0, 3.0, 3.0), ("c", "elevation", None, None, None, None)]
    items = spark.createDataFrame(rows, "item_id string, collection string, west double, south double, east double, north double")
    ids = lambda frame: sorted(r["item_id"] for r in frame.collect())
    assert ids(search.search(items, intersects={"type": "Point", "coordinates": [1, 1]})) == ["a"]
    assert ids(search.search(items, intersects={"type": "LineString", "coordinates": [[-1, 2], [2.5, 2.5]]})) == ["b"]
    own = items.withColumn("geometry", F.lit('{"type":"Point","coordinates":[0.5,0.5]}'))
    assert ids(search.search(own, intersects={"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]})) == ["a"]


def test_hilbert_curve_steps_to_neighbours(spark):
    cells = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    keys = {r["k"]: (r["x"], r["y"]) for r in cells.select("x", "y", curve.hilbert(F.col("x"), F.col("y"), 4).alias("k")).collect()}
    assert sorted(keys) == list(range(256))
    assert all(abs(keys[k][0] - keys[k + 1][0]) + abs(keys[k][1] - keys[k + 1][1]) == 1 for k in range(255))
    odd = spark.createDataFrame([(None, 0.0, 1.0, 1.0), (float("nan"), 0.0, 1.0, 1.0), (-400.0, -95.0, -390.0, -92.0)], "w double, s double, e double, n double")
    assert [r[0] for r in odd.select(curve.box_key(*(F.col(c) for c in "wsen"))).collect()] == [None, None, 0]


def test_store_opens_few_files(spark, tmp_path):
    items = spark.range(20_000).select(
        F.concat(F.lit("i"), "id").alias("item_id"), F.lit("elevation").alias("collection"), F.lit("2020-01-01T00:00:00Z").alias("datetime"), F.lit(False).alias("datetime_unknown"),
        *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_000)) / 100_000.0 * span + low + more).alias(n) for n, k, span, low, more in (("west", 1, 350, -179, 0.0), ("south", 2, 170, -89, 0.0), ("east", 1, 350, -179, 0.01), ("north", 2, 170, -89, 0.01))])
    path = str(tmp_path / "store")
    itemstore.write_store(items, path, per_file=200)
    box = [-125.0, 48.0, -115.0, 55.0]
    found = itemstore.search_store(spark, path, bbox=box)
    assert sorted(r["item_id"] for r in found.collect()) == sorted(r["item_id"] for r in search.search(items, bbox=box).collect()) != []
    everything = len(spark.read.parquet(f"{path}/data").inputFiles())
    assert everything >= 90 and len(found.inputFiles()) < everything / 10
    assert itemstore.search_store(spark, path, bbox=[179.5, 89.5, 180.0, 90.0]).count() == 0
    assert itemstore.meeting_files(spark, path, interval="2021-01-01/..").count() == 0 and itemstore.search_store(spark, path, interval="../2019-12-31").count() == 0
    assert itemstore.search_store(spark, path, bbox=[-130.0, 40.0, -120.0, 50.0], intersects={"type": "Point", "coordinates": [0.0, 0.0]}).count() == 0


def test_store_of_one_place_and_of_no_place(spark, tmp_path):
    one = spark.range(3000).select(F.concat(F.lit("i"), "id").alias("item_id"), F.lit("2020-01-01T00:00:00Z").alias("datetime"), *[F.lit(v).alias(n) for n, v in zip(search.BOX, (1.0, 1.0, 2.0, 2.0), strict=True)])
    none = one.where("item_id < 'i1'").select("item_id", "datetime", *[F.lit(None).cast("double").alias(n) for n in search.BOX])
    path = str(tmp_path / "store")
    itemstore.write_store(one.unionByName(none), path, per_file=500)
    assert itemstore.manifest(spark, path).agg(F.max("items")).first()[0] < 1500  # split by id
    assert itemstore.search_store(spark, path, bbox=[0.0, 0.0, 1.0, 1.0]).count() == 3000 and itemstore.search_store(spark, path).count() == 3000 + none.count()
    itemstore.write_store(one.limit(0), path)
    assert itemstore.search_store(spark, path, bbox=[0.0, 0.0, 1.0, 1.0]).count() == 0 and itemstore.search_store(spark, path).count() == 0


def test_small_files_need_no_tasks_of_their_own(spark, tmp_path):
    items = spark.range(3000).select(F.concat(F.lit("i"), "id").alias("item_id"), F.lit("2020-01-01T00:00:00Z").alias("datetime"), *[(F.col("id") / 30.0).alias(n) for n in search.BOX])
    path = str(tmp_path / "store")
    itemstore.write_store(items, path, per_file=50)
    names = [r["file"] for r in itemstore.manifest(spark, path).collect()]
    assert len(names) >= 60 and itemstore.manifest(spark, path).agg(F.max("items")).first()[0] <= 50
    assert len({n.split("-")[1] for n in names}) == 1  # the number of the task
    assert itemstore.search_store(spark, path).count() == 3000


def test_geometries_are_parsed_once(spark, tmp_path):
    text = lambda kind, points: json.dumps({"type": kind, "coordinates": points})
    left = spark.createDataFrame([("a", text("LineString", [[0.2, 0.2], [3.7, 2.1]])), ("b", text("Point", [2.0, 2.0])), ("c", text("Point", [9.0, 9.0])), ("d", "?")], "l string, geometry string")
    right = spark.createDataFrame([(1, text("Polygon", [[[1.0, 0.0], [3.0, 0.0], [3.0, 3.0], [1.0, 3.0], [1.0, 0.0]]])), (2, text("Point", [9.0, 9.0]))], "r int, geometry string")
    found = geometry.geometry_join(left, right, "l", "r", folder=str(tmp_path / "shapes"))
    assert sorted(map(tuple, found.collect())) == [("a", 1), ("b", 1), ("c", 2)] == sorted(map(tuple, geometry.geometry_join(left, right, "l", "r").collect()))
    assert "from_json" not in found._jdf.queryExecution().toString()
