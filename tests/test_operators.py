"""Catalog operators: properties that hold between them, and their edge cases."""

import pytest
from pyspark.sql import functions as F

from orolith import schema
from orolith.operators import access, changes, collection, items, publish, qa, search, validate
from orolith.plans import fixtures as fx
from orolith.plans import pipeline
from orolith.sources import adapters, readers, writers

SF = "/root/testdata/sf0.001"
P = "https:/objects.example.org/tiles"


def lines(spark, *urls):
    return spark.createDataFrame(list(enumerate(urls)), schema.INVENTORY)


def test_set_difference_is_distinct_and_keeps_the_first_place(spark):
    rows = changes.new_urls(lines(spark, "b", "a", "b", None, None, "c"), lines(spark, "c")).orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [(0, "b"), (1, "a"), (3, None)]


@pytest.mark.parametrize(("cached", "fresh", "code"), [(10, 9, 1), (10, 8, 2), (0, 9, 1), (10, 10, 0), (0, 0, 0)])
def test_guard(spark, cached, fresh, code):
    row = changes.compare_listings(lines(spark, *map(str, range(fresh))), lines(spark, *map(str, range(cached)))).first()
    assert row["exit_code"] == code and row["refused"] == (code == 2)


def test_algebra_of_changes(spark):
    fresh, cached = fx.relation(spark, SF, fx.FRESH), fx.relation(spark, SF, fx.CACHED)
    new, deleted = changes.new_urls(fresh, cached), changes.deleted_urls(fresh, cached)
    assert new.count() + changes.unchanged_count(fresh, cached).first()[0] == fresh.select("url").distinct().count()
    assert deleted.join(fresh, "url").count() == 0
    assert changes.compare_listings(fresh, fresh).first()["exit_code"] == 0


def test_last_cache_row_wins_and_statuses(spark):
    checks = spark.createDataFrame([
        (0, f"{P}/a_utm10_2019.tif", False, False, None, None, None, None, None), (1, f"{P}/a_utm10_2019.tif".replace(":/", "://"), True, True, 26910, 5, 6, [1.0, 0.0, 5e5, 0.0, -1.0, 5.5e6], [5e5, 5.4e6, 5.1e5, 5.5e6]),
        (2, f"{P}/b_utm10_20231345.tif", True, False, 26910, 5, 6, [1.0] * 6, [5e5, 5.4e6, 5.1e5, 5.5e6]), (3, f"{P}/c.tif", True, False, None, 5, 6, [1.0] * 6, [1.0] * 4), (4, f"{P}/d_utm10_20234.tif", True, False, 26910, 5, 6, [1.0] * 6, [5e5, 5.4e6, 5.1e5, 5.5e6]),
        (5, f"{P}/e.tif", True, False, 1234, 5, 6, [1.0] * 6, [1.0] * 4), (6, f"{P}/f.tif", False, False, None, None, None, None, None)], schema.CHECKS)
    inventory = lines(spark, f"{P}/a_utm10_2019.tif", f"{P}/b_utm10_20231345.tif", f"{P}/c.tif", f"{P}/d_utm10_20234.tif", f"{P}/e.tif", f"{P}/f.tif", f"{P}/g.tif", "", None)
    rows = items.resolve(inventory, checks)
    assert [r["status"] for r in rows.orderBy("ordinal").collect()] == ["built", "bad_date", "needs_remote", "error", "error", "unreadable", "no_cache", "no_cache", "no_cache"]
    counts = items.status_counts(rows).first()
    assert counts["batch_poisoned"] and counts["shortfall"] == 8
    doc = validate.report(items.item_documents(items.built_items(rows)).select(F.concat("id", F.lit(".json")).alias("item_path"), "body")).first()
    assert doc["json_valid"] and doc["item_id"] == "a_utm10_2019"


def test_links_added_and_skipped(spark):
    ids = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b")], "ordinal long, item_id string")
    there = spark.createDataFrame([("item", f"{schema.PUBLISHED}/b.json"), ("self", f"{schema.PUBLISHED}/a.json")], "rel string, href string")
    assert tuple(items.link_counts(items.merge_links(there, ids)).first()) == (2, 1)
    assert tuple(items.link_counts(items.merge_links(there, ids, distinct=True)).first()) == (1, 1)
    assert items.keep_links(there, "full", True).count() == 1 and items.keep_links(there, "incremental", True).count() == 2


def test_increment_equals_full_build(spark):
    fresh, cached, checks = (fx.relation(spark, SF, x) for x in (fx.FRESH, fx.CACHED, fx.CHECKS))
    empty = spark.createDataFrame([], schema.REPORT)
    links = spark.createDataFrame([], "rel string, href string")
    status, run = pipeline.increment(fresh, cached, checks, empty, links)
    assert status.first()["exit_code"] == 1
    full = pipeline.build(fresh, checks, links)
    key = ["item_id", "status"]
    assert run.rows.select(*key).subtract(full.rows.select(*key)).count() == 0
    built = run.rows.where("status = 'built'").count()
    assert run.report.count() == built == run.links.where("added").count()
    again = run.links.where("added").select(F.lit("item").alias("rel"), "href")
    assert items.link_counts(items.merge_links(again, run.rows.where("status = 'built'").select("ordinal", "item_id"))).first()["added"] == 0
    refused, nothing = pipeline.increment(fresh.limit(3), cached, checks, empty, links)
    assert refused.first()["refused"] and nothing.rows.count() == 0


def test_modes(spark):
    a, b, c = lines(spark, "a"), lines(spark, "b"), lines(spark, *"cdefghijklmn")
    assert pipeline.choose_inventory(c, b, a, "reprocess").first()["url"] == "a"
    assert pipeline.choose_inventory(c, b, a, "incremental").first()["url"] == "b"
    assert pipeline.choose_inventory(c, test=True).count() == schema.TEST_COUNT
    with pytest.raises(ValueError):
        pipeline.choose_inventory(c, mode="incremental")


def test_extents_of_nothing(spark):
    assert collection.temporal_extent(lines(spark)).first()["empty"]
    row = collection.temporal_extent(lines(spark, "x/2019/a.tif", "y", "z_utm10_20180203.tif")).first()
    assert (row["first"], row["last"], row["dated"]) == ("2018-02-03T00:00:00Z", "2019-01-01T00:00:00Z", 2)
    boxes = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0],), (None,), ([-1.0, 2.0, 1.0, 5.0],)], "bbox array<double>")
    assert tuple(collection.bbox_union(boxes).first()) == (-1, 1, 2, 5, False)
    doc = collection.collection_document(collection.temporal_extent(lines(spark, "x/2019/a.tif")))
    assert collection.collection_errors(doc.select("collection.*")).first()["errors"] == []
    assert collection.collection_errors(spark.createDataFrame([("{}",)], "v string").select(F.from_json("v", schema.COLLECTION).alias("c")).select("c.*")).first()["errors"]


def test_report_classes(spark):
    good = '{"type":"Feature","stac_version":"1.1.0","id":"a","geometry":null,"properties":{"datetime":"2019-01-01T00:00:00Z"},"links":[],"assets":{}}'
    rows = validate.report(spark.createDataFrame([("a.json", good), ("b.json", None), ("c.json", good[:30]), ("d.json", good.replace("Feature", "X")), ("e.json", "[1]")], "item_path string, body string")).orderBy("item_path").collect()
    assert [r["json_valid"] for r in rows] == [True, False, False, False, False]
    assert rows[1]["validation_error"] == "File not found" and rows[2]["validation_error"].startswith("JSON decode error") and rows[3]["validation_error"] == "STAC validation error: type"
    summary = validate.summary(spark.createDataFrame(rows)).first()
    assert (summary["total"], summary["invalid"], summary["exit_code"]) == (5, 4, 1)
    none = validate.summary(spark.createDataFrame([], schema.REPORT)).first()
    assert (none["total"], none["percent"], none["exit_code"]) == (0, 0.0, 0)


def test_increment_skips_what_was_invalid(spark):
    bad = spark.createDataFrame([("a.json", "a", True, False, "x", "t")], schema.REPORT)
    new = bad.limit(0)
    assert validate.incremental_status(bad, new).first()["exit_code"] == 0
    assert validate.not_reported(spark.createDataFrame([("a.json",), ("b.json",)], "item_path string"), bad).count() == 1
    assert validate.incremental_status(bad, bad.withColumn("json_valid", F.lit(True))).first()["exit_code"] == 1


def test_access(spark):
    def head(url):
        if "bad" in url:
            raise OSError("refused")
        return (200, "OK") if "ok" in url else (404, "Not Found")

    probes = adapters.head_probe(lines(spark, "ok", "gone", "bad"), head, 2)
    rows = {r["url"]: r for r in access.classify(probes, "t").collect()}
    assert rows["ok"]["accessible"] and rows["ok"]["error"] == "" and rows["gone"]["error"] == "Not Found" and rows["bad"]["status_code"] is None
    cache = spark.createDataFrame(list(rows.values()), schema.ACCESS)
    assert access.exit_status(cache, cache.limit(0)).first()["exit_code"] == 1
    assert access.exit_status(cache, cache.where("accessible")).first()["exit_code"] == 0
    assert access.to_check(lines(spark, "ok", "new"), cache).count() == 1 and access.to_check(lines(spark, "ok", "new"), cache, recheck=True).count() == 2


def test_headers(spark):
    def read(url):
        if "bad" in url:
            raise OSError
        assert " " not in url and url.startswith("https://")
        return {"is_cog": True, "epsg": 26910, "height": 2, "width": 3, "transform": [1.0, 0, 0, 0, -1, 0, 0, 0, 1], "bounds": [0.0, 0, 1, 1]}

    rows = {r["url"]: r for r in adapters.raster_headers(lines(spark, "https:/h/a b.tif", "bad"), read, 2).collect()}
    assert len(rows["https:/h/a b.tif"]["transform"]) == 6 and not rows["bad"]["is_geotiff"] and rows["bad"]["bounds"] is None


def test_qa(spark):
    local = fx.relation(spark, SF, fx.LOCAL)
    same = qa.summary(qa.differences(local, local)).first()
    assert same["passed"] and same["checked"] == local.count()
    assert not qa.summary(qa.differences(local, local.limit(5))).first()["passed"]
    assert qa.sample_size(0) == 1 and qa.sample_size(0, at_least_one=False) == 0 and qa.sample_size(50) == 1 and qa.sample_size(58_000) == 100 and qa.sample_size(1000, 5, 200) == 50
    assert sorted(qa.sample(local, 10).select("name").collect()) == sorted(qa.sample(local, 10).select("name").collect())


def test_grid_join_equals_theta_join(spark):
    left, right = fx.relation(spark, SF, fx.ITEMS), fx.relation(spark, SF, fx.AREAS)
    plain = spark.sql(f"SELECT i.item_id, a.area_id FROM ({fx.as_spark(fx.ITEMS, SF)}) i JOIN ({fx.as_spark(fx.AREAS, SF)}) a ON i.east >= a.west AND i.west <= a.east AND i.north >= a.south AND i.south <= a.north")
    for cell in (0.3, 1.0, 5.0):
        assert sorted(search.spatial_join(left, right, cell).collect()) == sorted(plain.collect())


def test_search_ends_are_inclusive(spark):
    rows = spark.createDataFrame([("a", "c", "2018-01-01T00:00:00Z", 0.0, 0.0, 1.0, 1.0), ("b", "c", "2000-01-01T00:00:00Z", 5.0, 5.0, 6.0, 6.0)], "item_id string, collection string, datetime string, west double, south double, east double, north double")
    found = lambda **k: [r["item_id"] for r in search.search(rows, **k).orderBy("item_id").collect()]
    assert found(interval="2018-01-01/2018-01-01") == ["a"] and found(interval="../2001-01-01") == ["b"] and found(bbox=[1, 1, 2, 2]) == ["a"] and found(collection="x") == []
    square = {"type": "Polygon", "coordinates": [[[1, 1], [5, 1], [5, 5], [1, 5], [1, 1]]]}
    assert found(intersects=square) == ["a", "b"] and found(intersects={"type": "MultiPolygon", "coordinates": [square["coordinates"]]}) == ["a", "b"]
    assert search.page(rows, 1, 1).first()["item_id"] == "b"


def test_files(spark, tmp_path):
    path = str(tmp_path / "urls")
    assert readers.read_lines(spark, path, optional=True).count() == 0
    assert writers.write_lines_or_remove(lines(spark, "b", "a"), path)
    assert [r["url"] for r in readers.read_lines(spark, path).orderBy("ordinal").collect()] == ["b", "a"]
    assert not writers.write_lines_or_remove(lines(spark), path) and not writers.exists(spark, path)
    checks = fx.relation(spark, SF, fx.CHECKS)
    writers.rewrite_csv(checks.orderBy("ordinal"), str(tmp_path / "checks"))
    back = readers.read_checks(spark, str(tmp_path / "checks"))
    cols = ["url", "is_geotiff", "is_cog", "epsg", "height", "width", "transform", "bounds"]
    assert back.select(*cols).exceptAll(checks.select(*cols)).count() == 0 and back.count() == checks.count()
    (tmp_path / "old.csv").write_text("url,is_geotiff,is_cog\na,True,False\nb,,true\n")
    old = {r["url"]: r for r in readers.read_checks(spark, str(tmp_path / "old.csv")).collect()}
    assert old["a"]["is_geotiff"] and old["a"]["epsg"] is None and not old["b"]["is_geotiff"] and items.needs_upgrade(spark.createDataFrame(list(old.values()), back.schema)).count() == 1
    (tmp_path / "items").mkdir()
    for name in ("a-b.json", "c.json", "collection.json", "x.txt"):
        (tmp_path / "items" / name).write_text("{}")
    folder = str(tmp_path / "items")
    assert readers.read_documents(spark, folder).count() == 2 and readers.read_documents(spark, folder, "*-*.json").count() == 1 and readers.count_json(spark, folder) == 3
    docs = spark.createDataFrame([("p/1", '{"a":1}'), ("q 2", '{"b":2}')], "item_id string, body string").withColumn("item_id", F.replace("item_id", F.lit("/"), F.lit("-")))
    assert writers.export_documents(docs, str(tmp_path / "out")) == 2 and (tmp_path / "out" / "q 2.json").read_text() == '{"b":2}\n'


def test_publish(spark, tmp_path):
    path = str(tmp_path / "catalog")
    doc = lambda *rows: spark.createDataFrame(list(rows), "id string, body string")
    one = doc(("c", "{}"))
    with pytest.raises(ValueError):
        publish.preflight(spark.createDataFrame([], "id string, body string"), one)
    assert publish.publish(doc(("a", "1"), ("b", "1")), one, path + "/") == {"add": 2}
    assert publish.publish(doc(("b", "2"), ("d", "1")), one, path) == {"add": 1, "update": 1}
    read = lambda: {r["id"]: r["body"] for r in spark.read.parquet(f"{path}/items").collect()}
    assert read() == {"a": "1", "b": "2", "d": "1"}
    assert publish.publish(doc(("d", "1")), one, path, mirror=True) == {"keep": 1, "delete": 2} and read() == {"d": "1"}
    with pytest.raises(ValueError):
        publish.promote(spark, str(tmp_path / "none"), path)
    publish.publish(doc(("z", "1")), one, str(tmp_path / "staged"))
    backup = publish.promote(spark, str(tmp_path / "staged"), path)
    assert read() == {"z": "1"}
    writers.roll_back(spark, path, backup)
    assert read() == {"d": "1"}


def test_joins_keep_repeated_ids(spark):
    """Equal rows are rows of their own: none is lost, none multiplied."""
    box = "west double, south double, east double, north double"
    rows = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 1.0)] * 3 + [("b", 5.0, 5.0, 6.0, 6.0)], f"item_id string, {box}")
    areas = spark.createDataFrame([(1, [[[0.5, -1.0], [3.0, 0.5], [0.5, 2.0], [0.5, -1.0]]])] * 2, "area_id int, rings array<array<array<double>>>")
    assert sorted(tuple(r) for r in search.polygon_join(rows, areas).collect()) == [("a", 1)] * 6
    outline = {"type": "MultiPolygon", "coordinates": [[[[0.5, -1.0], [3.0, 0.5], [0.5, 2.0], [0.5, -1.0]]], [[[5.5, 5.5], [9.0, 5.5], [9.0, 9.0], [5.5, 5.5]]]]}
    assert sorted(r["item_id"] for r in search.in_polygon(rows, outline).collect()) == ["a", "a", "a", "b"]


def test_bounds_in_columns_equal_those_of_one_expression(spark):
    from orolith.functions import geo

    rows = [([604000.0, 5962000.0, 618000.0, 5974000.0], e) for e in (3157, 26910, 32609, 4326, 9999, None)] + [(None, 3005), ([1.0, 2.0], 3005), ([900000.0, 500000.0, 1100000.0, 700000.0], 3005), ([450000.0, 5500000.0, 550000.0, 5600000.0], 2955)]
    frame = spark.createDataFrame(rows, "bounds array<double>, epsg int").withColumn("box", geo.transform_bounds(F.col("bounds"), F.col("epsg")))
    for row in geo.add_bounds(frame, "bounds", "epsg", "found").collect():
        assert row["found"] == (None if row["box"] is None else pytest.approx(row["box"], abs=1e-11))
    plan = geo.add_bounds(frame.drop("box"), "bounds", "epsg", "found")._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan


def test_link_summary_and_counts(spark):
    links = spark.createDataFrame([(2, "item", "b"), (1, "self", "a"), (3, None, None)], "ordinal int, rel string, href string")
    assert collection.link_summary(links).first()[:3] == (3, 1, "a") and collection.link_summary(links.limit(0)).first()[:2] == (0, 0)
    assert {tuple(r) for r in collection.count_links(links).collect()} == {("item", 1), ("self", 1), (None, 1)}
