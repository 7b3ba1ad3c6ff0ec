"""Scalar functions against the cases that decide their meaning."""

import pytest
from pyspark.sql import functions as F

from orolith.functions import dates, geo, urls

P = "https://objects.example.org/tiles"


def one(spark, column, value=None):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("url", "text"), [
    ("a_utm10_20230415.tif", "20230415"), ("a_utm9_2019.tif", "2019"), ("/2017/x.tif", "2017"), ("/2999/2017/x", None), ("/2017/2018/x", "2017"), ("a_utm10_19990101/2018/", "2018"),
    ("a_utm10_202304.tif", "202304"), ("a_utm10_2023041599.tif", "20230415"), ("a_utm100_2020", None), ("a_utm10_1998_utm11_2005", None), ("_utm10_20500101", "20500101"), ("/2051/", None), ("", None),
])
def test_date_text(spark, url, text):
    assert one(spark, dates.date_text(F.col("v")), url) == text


@pytest.mark.parametrize(("text", "day", "bad"), [("20230415", "2023-04-15T00:00:00Z", False), ("2019", "2019-01-01T00:00:00Z", False), ("202304", None, False), ("20231345", None, True), ("20230229", None, True), (None, None, False)])
def test_parse_date(spark, text, day, bad):
    row = spark.createDataFrame([(text,)], "v string").select(dates.rfc3339(dates.parse_date(F.col("v"))), dates.is_bad_date(F.col("v"))).first()
    assert tuple(row) == (day, bad)


@pytest.mark.parametrize(("url", "item"), [
    (f"{P}/a/b.tif", "a-b"), (f"{P.replace('//', '/', 1)}/a/b.tif", "a-b"), (f"{P}//a/b (2).tif", "a-b (2)"), (f"{P}/a/b.TIF", "a-b.TIF"), (f"{P}/a-c/b.tif.tif", "a-c-b.tif"), ("short", ""), ("", ""),
])
def test_item_id(spark, url, item):
    assert one(spark, urls.item_id(F.col("v")), url) == item


@pytest.mark.parametrize(("url", "fixed"), [("https:/h/x", "https://h/x"), ("https://h/x", "https://h/x"), ("http:/h", "http:/h"), ("", "")])
def test_fix_scheme(spark, url, fixed):
    assert one(spark, urls.fix_scheme(F.col("v")), url) == fixed


def test_names(spark):
    assert one(spark, urls.stem(F.col("v")), "x/a.b.json") == "a.b"
    assert one(spark, urls.stem(F.col("v")), ".json") == ".json"
    assert one(spark, urls.url_from_id(F.col("v")), "a-b") == f"{P}/a/b.tif"
    assert one(spark, urls.reader_path(F.col("v")), "https:/h/a b") == "/vsicurl/https://h/a%20b"
    assert len(one(spark, urls.error_text("E", F.col("v")), "m" * 300)) == 103


def test_published_projection_points(spark):
    """Round trips, and a corner that the survey's authors computed: a box in zone 10."""
    box = one(spark, geo.transform_bounds(F.array(*[F.lit(float(v)) for v in (604000, 5962000, 618000, 5974000)]), F.lit(3157)))
    assert [round(v, 5) for v in box] == [-121.42106, 53.79318, -121.20400, 53.90398]
    assert one(spark, geo.transform_bounds(F.array(*[F.lit(float(v)) for v in (1, 2, 3, 4)]), F.lit(9999))) is None
    assert one(spark, geo.transform_bounds(F.array(*[F.lit(float(v)) for v in (1, 2, 3, 4)]), F.lit(4326))) == [1, 2, 3, 4]
    points = spark.createDataFrame([(-123.4, 49.2), (-126.0, 58.9), (-120.1, 54.5)], "lon double, lat double")
    x, y = geo.lonlat_to_utm(F.col("lon"), F.col("lat"), F.lit(-123.0))
    ax, ay = geo.lonlat_to_albers(F.col("lon"), F.col("lat"))
    for row in points.select("lon", "lat", x.alias("x"), y.alias("y"), ax.alias("ax"), ay.alias("ay")).select("lon", "lat", *geo.utm_to_lonlat(F.col("x"), F.col("y"), F.lit(-123.0)), *geo.albers_to_lonlat(F.col("ax"), F.col("ay"))).collect():
        assert row[2:] == pytest.approx((row[0], row[1], row[0], row[1]), abs=1e-8)


def test_tile_of_a_centre(spark):
    assert one(spark, F.array(geo.tile_x(F.lit(0.0), 1), geo.tile_y(F.lit(0.0), 1))) == [1, 1]


@pytest.mark.parametrize(("box", "meets"), [((0, 0, 1, 1), True), ((2, 2, 3, 3), True), ((-5, -5, 20, 20), True), ((4, 4, 6, 6), False), ((10, 0, 11, 1), True), ((10.1, 0, 11, 1), False), ((4.4, 4.4, 4.6, 4.6), False), ((3, 3, 4.5, 4.5), True)])
def test_polygon_with_a_hole(spark, box, meets):
    outer = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    hole = [[3.5, 3.5], [7, 3.5], [7, 7], [3.5, 7], [3.5, 3.5]]
    rings = F.array(*[F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ring]) for ring in (outer, hole)])
    assert one(spark, geo.polygon_meets_box(rings, *[F.lit(float(v)) for v in box])) is meets


def test_wkt_and_rings(spark):
    assert one(spark, geo.parse_wkt_polygon(F.col("v")), "polygon((0 0, 1 0,1 1 , 0 0))") == [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    assert one(spark, geo.parse_wkt_polygon(F.col("v")), "POINT (1 2)") is None
    ring = geo.box_ring(*[F.lit(float(v)) for v in (0, 1, 2, 3)])
    assert one(spark, ring) == [[2, 1], [2, 3], [0, 3], [0, 1], [2, 1]]
    assert one(spark, geo.ring_box(ring)) == [0, 1, 2, 3]


def test_years_are_compared_without_failing_casts(spark):
    """a cast of no year to a number threw and caught, up to four times a row, and dates were parsed twice."""
    from orolith import schema

    source = schema.SOURCE.rstrip("/")
    texts = ["", "1999", "2000", "2050", "2051", "20500101", "199912", "20191332"]
    addresses = [f"{source}/{year}dem/a_utm10_{x}.tif" for x in texts for year in ("", "1999/", "2000/", "2049/", "2051/")]
    rows = dates.with_dates(spark.createDataFrame([(u,) for u in addresses], "url string"))
    year = lambda x: x[:4].isdigit() and 2000 <= int(x[:4]) <= 2050
    for u, got in rows.select("url", "date_text").collect():
        utm, path = u.rsplit("_", 1)[1][:-4], u.removeprefix(source).split("dem/")[0].strip("/")
        assert got == (utm if year(utm) else path if year(path) else None), u
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in plan and plan.count("yyyyMMdd") == 1
