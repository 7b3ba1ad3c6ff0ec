"""The command line: what it writes, and its exit codes."""

import pytest

from orolith.__main__ import main
from orolith.operators import collection
from orolith.plans import fixtures as fx
from orolith.sources import adapters, readers, writers
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
P = "https://objects.example.org/tiles"


def head(url):
    if "gone" in url:
        raise OSError("gone")
    return 200, "OK"


@pytest.fixture
def urls(tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
        return str(tmp_path / name)

    return write


def test_detect(spark, urls, tmp_path):
    run = lambda fresh, cached: main(["detect", "--fresh", fresh, "--cached", cached, "--new", str(tmp_path / "new"), "--deleted", str(tmp_path / "deleted")], spark)
    a, b = urls("a", f"{P}/1.tif", f"{P}/2.tif"), urls("b", f"{P}/2.tif")
    assert run(a, b) == 1 and [r["url"] for r in readers.read_lines(spark, str(tmp_path / "new")).collect()] == [f"{P}/1.tif"] and not (tmp_path / "deleted").exists()
    assert run(a, b) == 0 and not (tmp_path / "new").exists()  # the fresh list has become the cached one
    one = urls("one", f"{P}/2.tif")
    assert run(one, a) == 2 and readers.read_lines(spark, a).count() == 2
    slash = urls("slash", f"{P}/1.tif".replace("//", "/"), f"{P}/2.tif")
    assert run(slash, a) == 1 and [r["url"] for r in readers.read_lines(spark, str(tmp_path / "deleted")).collect()] == [f"{P}/1.tif"]
    assert [r["url"] for r in readers.read_lines(spark, a).orderBy("ordinal").collect()] == (tmp_path / "slash").read_text().split()
    assert run(b, str(tmp_path / "nothing")) == 1


def test_build_validate_qa_and_reconcile(spark, urls, tmp_path):
    inventory, checks = fx.relation(spark, SF, fx.INVENTORY), str(tmp_path / "checks")
    writers.rewrite_csv(fx.relation(spark, SF, fx.CHECKS), checks)
    listed = urls("list", *[r["url"] for r in inventory.orderBy("ordinal").limit(40).collect()])
    out = str(tmp_path / "out")
    assert main(["build", "--urls", listed, "--checks", checks, "--out", out], spark) == 0
    assert main(["build", "--urls", listed, "--checks", checks, "--out", f"{out}-test", "--test", "--test-count", "5", "--mode", "incremental"], spark) == 0
    assert spark.read.parquet(f"{out}-test/rows").count() == 5 and spark.read.parquet(f"{out}/rows").count() == 40
    documents = spark.read.parquet(f"{out}/documents")
    items, report = str(tmp_path / "items"), str(tmp_path / "report")
    n = writers.export_documents(documents.select(F.col("id").alias("item_id"), "body"), items)
    assert n == documents.count() > 0
    assert main(["validate", "--items-dir", items, "--output", report], spark) == 0 and readers.read_report(spark, report).count() == n
    (tmp_path / "items" / "bad-one.json").write_text("{")
    assert main(["validate", "--items-dir", items, "--output", report, "--incremental"], spark) == 1 and readers.read_report(spark, report).count() == n + 1
    assert main(["validate", "--items-dir", items, "--output", report, "--incremental"], spark) == 0  # nothing new, though history holds a fault
    assert main(["validate", "--items-dir", str(tmp_path / "no-items"), "--output", report], spark) == 1 and readers.read_report(spark, report).count() == n + 1
    again = str(tmp_path / "again")
    assert main(["extract-invalid", "--report", report, "--output", again], spark) == 0
    assert [r["url"] for r in readers.read_lines(spark, again).collect()] == [f"{P}/bad/one.tif"]
    qa = lambda other: main(["qa", "--local-dir", items, "--remote-dir", other, "--sample-percent", "100"], spark)
    assert qa(items) == 0
    (tmp_path / "other").mkdir()
    assert qa(str(tmp_path / "other")) == 1
    assert main(["reconcile", "--urls", listed, "--items-dir", items], spark) == 1
    assert main(["reconcile", "--urls", listed, "--items-dir", items, "--apply"], spark) == 1 and readers.read_lines(spark, listed).count() == n
    assert main(["reconcile", "--urls", listed, "--items-dir", items], spark) == 0
    assert main(["reconcile", "--urls", listed, "--items-dir", str(tmp_path / "other"), "--apply"], spark) == 2


def test_access_and_promote(spark, urls, tmp_path):
    listed, out = urls("list", f"{P}/1.tif", f"{P}/gone.tif"), str(tmp_path / "access")
    probe = ["access", "--urls-file", listed, "--output", out, "--head", "tests.test_cli:head", "--workers", "1"]
    try:
        import tests.test_cli  # noqa: F401
    except ImportError:
        probe[6] = "test_cli:head"
    assert main(probe, spark) == 1 and readers.read_access(spark, out).where("accessible").count() == 1
    assert main(probe, spark) == 1  # nothing to check: the cache decides
    (tmp_path / "list").write_text(f"{P}/1.tif\n{P}/gone.tif\n{P}/3.tif\n")
    assert main(probe, spark) == 0 and readers.read_access(spark, out).count() == 3  # only what was checked decides
    (tmp_path / "list").write_text(f"{P}/3.tif\n")
    assert main([*probe, "--recheck"], spark) == 0 and [r["url"] for r in readers.read_access(spark, out).collect()] == [f"{P}/3.tif"]
    assert main(["promote", "--staged", str(tmp_path / "none"), "--production", str(tmp_path / "p")], spark) == 2


def test_fetch_collection_and_publish(spark, urls, tmp_path):
    out, name = str(tmp_path / "listed"), "orolith.plans.fixtures:listing"
    fetch = ["fetch", "--output", out, "--lister", name, "--prefixes", ",".join(str(tmp_path / k) for k in ("b", "a", "absent"))]
    for k in "ab":
        (tmp_path / k).mkdir()
        (tmp_path / k / "names").write_text("".join(f"{P}/{k}/{x}\n" for x in ("dem/2.tif", "dem/1.tif", "dem/1.tif", "dem/notes.txt", "photo.tif")))
    assert main(fetch, spark) == 0
    assert [r["url"] for r in readers.read_lines(spark, out).orderBy("ordinal").collect()] == [f"{P}/{k}/dem/{n}.tif" for k in "ab" for n in (1, 2)]
    (tmp_path / "rasters").mkdir()
    (tmp_path / "rasters" / "other.tif").write_text("")
    assert main(["fetch", "--output", out, "--folder", str(tmp_path / "rasters")], spark) == 2 and readers.read_lines(spark, out).count() == 4
    assert main(["fetch", "--output", out, "--folder", str(tmp_path / "rasters"), "--test"], spark) == 0

    folder = tmp_path / "catalog-items"
    folder.mkdir()
    dated = urls("dated", f"{P}/001/2019/dem/x.tif", f"{P}/001/2021/dem/x.tif", f"{P}/dem/x.tif")
    (folder / "a-1.json").write_text("{}")
    assert main(["collection", "--urls", urls("undated", f"{P}/dem/x.tif"), "--out", str(folder)], spark) == 1 and not (folder / "collection.json").exists()
    assert main(["publish", "--items-dir", str(folder), "--catalog", str(tmp_path / "target")], spark) == 2
    assert main(["collection", "--urls", dated, "--out", str(folder)], spark) == 0 and (folder / "a-1.json").exists()
    extent = readers.read_collection(spark, str(folder / "collection.json")).select("extent.temporal.interval").first()[0]
    assert [x[:4] for x in extent[0]] == ["2019", "2021"]

    target = str(tmp_path / "target")
    send = ["publish", "--items-dir", str(folder), "--catalog", target]
    assert main([*send, "--dryrun"], spark) == 0 and not (tmp_path / "target").exists()
    assert main(send, spark) == 0
    (folder / "a-1.json").rename(folder / "a-2.json")
    held = lambda: {r["id"] for r in spark.read.parquet(f"{target}/items").collect()}
    assert main(send, spark) == 0 and held() == {"a-1", "a-2"}
    assert main([*send, "--mirror"], spark) == 0 and held() == {"a-2"}
    assert main(["collection", "--urls", dated, "--out", str(folder), "--test", "--test-count", "1"], spark) == 0
    assert [p.name for p in folder.iterdir() if p.suffix == ".json"] == ["collection.json"]


def test_probe_output_and_features(spark):
    said = [("1", "x.tif is a valid cloud optimized GeoTIFF"), ("2", "x.tif is NOT a valid cloud optimized GeoTIFF"), ("3", "error"), ("4", None)]
    rows = adapters.classify_probe_text(spark.createDataFrame(said, "url string, output string")).collect()
    assert [(r["is_geotiff"], r["is_cog"]) for r in rows] == [(True, True), (True, False), (False, False), (False, False)]
    areas = spark.createDataFrame([(2, "b", 0.0, 0.0, 1.0, 2.0), (1, "a", 3.0, 3.0, 4.0, 4.0)], "area_id int, name string, west double, south double, east double, north double")
    got = collection.features(areas, ["area_id", "name"])
    line = got.select(F.from_json("feature", "type string, properties map<string, string>, geometry struct<type: string, coordinates: array<array<array<double>>>>").alias("f")).where("f.properties['name'] = 'b'").first()["f"]
    assert line["type"] == "Feature" and line["geometry"]["type"] == "Polygon" and line["geometry"]["coordinates"][0][0] == [1.0, 0.0]
