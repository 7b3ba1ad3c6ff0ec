"""Queries that apply the catalog operators to the driver's tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolith import schema
from orolith.functions import dates, geo, urls
from orolith.operators import access, changes, collection, items, jsonschema, publish, qa, search, traverse, validate
from orolith.plans import fixtures as fx
from orolith.sources import adapters, readers, writers
from orolith.streaming import increments

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BOX = (-130.0, 50.0, -124.0, 54.0)
INTERVAL = "2018-01-01/2020-12-31"
POLYGON = {"type": "Polygon", "coordinates": [[[-128.0, 52.0], [-124.5, 51.0], [-122.0, 53.5], [-124.0, 56.0], [-127.5, 55.0], [-128.0, 52.0]]]}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _inventory(s, d):
    return fx.relation(s, d, fx.INVENTORY)


def _checks(s, d):
    return fx.relation(s, d, fx.CHECKS)


def _report(s, d):
    return fx.relation(s, d, fx.REPORT)


def _items(s, d):
    return fx.relation(s, d, fx.ITEMS)


def _reported(s, d):
    return fx.relation(s, d, fx.BACKING).select(urls.item_id(F.col("url")).alias("item_id"), "json_valid")


@query
def item_rows(s, d):
    rows = dates.with_dates(_inventory(s, d))
    return rows.select("ordinal", urls.item_id(F.col("url")).alias("item_id"), urls.fix_scheme(F.col("url")).alias("href"), "datetime", "datetime_unknown", F.col("date_status").alias("status"))


@query
def url_fix_scheme(s, d):
    return _inventory(s, d).select("ordinal", urls.fix_scheme(F.col("url")).alias("href"))


@query
def url_encode_space(s, d):
    return _inventory(s, d).select("ordinal", urls.encode_spaces(F.col("url")).alias("encoded"), urls.reader_path(F.col("url")).alias("opened"))


@query
def url_item_id(s, d):
    return _inventory(s, d).select("ordinal", urls.item_id(F.col("url")).alias("item_id"))


@query
def id_to_url_lossy(s, d):
    return _inventory(s, d).select("ordinal", urls.url_from_id(urls.item_id(F.col("url"))).alias("url"))


@query
def pages_url_parts(s, d):
    url = F.col("url")
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", urls.fix_scheme(url).alias("fixed"), urls.stem(url).alias("stem"), urls.strip_slash(url).alias("stripped"), urls.published_href(urls.stem(url)).alias("published"))


@query
def date_extract(s, d):
    return _inventory(s, d).select("ordinal", dates.date_text(F.col("url")).alias("date_text"))


@query
def datetime_parse(s, d):
    text = dates.date_text(F.col("url"))
    return _inventory(s, d).select("ordinal", dates.rfc3339(dates.parse_date(text)).alias("parsed"), dates.is_bad_date(text).alias("bad"))


@query
def datetime_placeholder(s, d):
    return dates.with_dates(_inventory(s, d)).select("ordinal", "datetime", "datetime_unknown")


@query
def inventory_filter_paren(s, d):
    return _inventory(s, d).where(~urls.has_parenthesis(F.col("url"))).select("ordinal", "url")


@query
def inventory_pattern(s, d):
    return s.read.parquet(f"{d}/part.parquet").select("p_partkey", F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, ".tif").otherwise(".txt"), F.when(F.col("p_partkey") % 2 == 0, "").otherwise(".dem.tif")).alias("name")).where(urls.is_raster_name(F.col("name")))


@query
def nonblank_lines(s, d):
    lines = _inventory(s, d).withColumn("url", F.when(F.col("ordinal") % 8 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.col("url"))))
    return readers.trimmed(lines)


def _listings(s, d):
    return fx.relation(s, d, fx.FRESH), fx.relation(s, d, fx.CACHED)


@query
def changes_new(s, d):
    return changes.new_urls(*_listings(s, d))


@query
def changes_deleted(s, d):
    return changes.deleted_urls(*_listings(s, d))


@query
def changes_unchanged_count(s, d):
    return changes.unchanged_count(*_listings(s, d))


@query
def changes_summary(s, d):
    return changes.compare_listings(*_listings(s, d))


@query
def changes_guard(s, d):
    fresh, cached = _listings(s, d)
    return changes.compare_listings(fresh.where("ordinal % 3 <> 0"), cached).select("fresh", "cached", "refused", "exit_code")


@query
def reconcile_backed(s, d):
    return changes.backed_urls(_inventory(s, d), _reported(s, d)).select("ordinal", "url")


@query
def reconcile_orphaned(s, d):
    return changes.orphaned_urls(_inventory(s, d), _reported(s, d)).select("ordinal", "url")


@query
def reconcile_counts(s, d):
    return changes.reconcile_counts(_inventory(s, d), _reported(s, d))


@query
def cache_last_wins(s, d):
    return items.cache_lookup(_checks(s, d)).select("key", "check.is_geotiff", "check.is_cog", F.coalesce("check.epsg", F.lit(0)).alias("epsg"), F.col("check.transform").isNotNull().alias("has_transform"))


@query
def cache_missing(s, d):
    return changes.missing_from(_inventory(s, d), _checks(s, d)).select("ordinal", "url")


@query
def cache_needs_upgrade(s, d):
    return items.needs_upgrade(_checks(s, d)).select("ordinal", "url")


@query
def cache_delta(s, d):
    return items.urls_to_check(_inventory(s, d), _checks(s, d)).select("ordinal", "url")


@query
def cache_union(s, d):
    checks, inventory = _checks(s, d), _inventory(s, d)
    fresh = items.urls_to_check(inventory, checks).select("ordinal", "url", F.lit(True).alias("is_geotiff"))
    merged = items.merge_cache(items.without_upgrading(checks, inventory), fresh)
    return merged.select("ordinal", "url", "is_geotiff", F.coalesce("is_cog", F.lit(False)).alias("is_cog"), F.coalesce("epsg", F.lit(0)).alias("epsg"))


@query
def item_status(s, d):
    return items.resolve(_inventory(s, d), _checks(s, d)).select("ordinal", "item_id", "status")


@query
def item_status_counts(s, d):
    return items.status_counts(items.resolve(_inventory(s, d), _checks(s, d)))


@query
def item_media_type(s, d):
    rows = items.resolve(_inventory(s, d), _checks(s, d)).where("is_geotiff")
    return rows.select("ordinal", urls.media_type(F.col("is_cog")).alias("media_type"))


def _links(s, d):
    there = _inventory(s, d).where("ordinal % 5 <> 1").select(F.lit("item").alias("rel"), urls.published_href(urls.item_id(F.col("url"))).alias("href"))
    batch = fx.relation(s, d, fx.FRESH).select("ordinal", urls.item_id(F.col("url")).alias("item_id"))
    return items.merge_links(there, batch)


@query
def item_links_delta(s, d):
    return _links(s, d)


@query
def item_links_counts(s, d):
    return items.link_counts(_links(s, d))


@query
def item_proj_fields(s, d):
    rows = items.resolve(_inventory(s, d), _checks(s, d)).where("transform IS NOT NULL")
    nine = geo.affine9(F.col("transform"))
    return rows.select("ordinal", *[F.element_at(nine, k).alias(f"t{k}") for k in range(1, 10)], F.array("height", "width")[0].alias("rows"), F.array("height", "width")[1].alias("cols"), F.element_at("bounds", 1).alias("left"), F.element_at("bounds", 4).alias("top"))


def _built(s, d):
    return items.built_items(items.resolve(_inventory(s, d), _checks(s, d)))


@query
def item_wgs84_bbox(s, d):
    return _built(s, d).select("ordinal", *[F.round(F.element_at("bbox", k), 6).alias(c) for k, c in enumerate(search.BOX, 1)])


@query
def collection_bbox_union(s, d):
    return collection.bbox_union(_built(s, d)).select(*[F.round(c, 6).alias(c) for c in search.BOX], "empty")


@query
def item_document_json(s, d):
    doc = F.from_json("body", "type string, stac_version string, collection string, properties struct<datetime: string, datetime_unknown: string, `proj:epsg`: int>, assets map<string, struct<href: string, type: string>>, links array<struct<rel: string>>").alias("d")
    rows = items.item_documents(_built(s, d)).select("ordinal", "id", doc)
    return rows.select(
        "ordinal", "id", "d.type", "d.stac_version", "d.properties.datetime", "d.properties.datetime_unknown", F.col("d.properties.`proj:epsg`").alias("epsg"),
        F.col("d.assets")["image"]["href"].alias("href"), F.col("d.assets")["image"]["type"].alias("media_type"), F.col("d.links")[0]["rel"].alias("rel"), "d.collection",
    )


@query
def temporal_extent(s, d):
    return collection.temporal_extent(_inventory(s, d))


@query
def collection_summary(s, d):
    extent = collection.temporal_extent(_inventory(s, d))
    doc = collection.collection_document(extent).select("collection.*")
    head = doc.select("license", F.size("links").cast("long").alias("own_links"), F.col("extent.spatial.bbox")[0][0].alias("west"), F.col("extent.temporal.interval")[0][0].alias("first"), F.col("extent.temporal.interval")[0][1].alias("last"))
    return head.join(collection.link_summary(_item_links(s, d)))


def _item_links(s, d):
    rel = F.when(F.col("ordinal") % 1000 == 0, "child").otherwise("item")
    return _inventory(s, d).select("ordinal", rel.alias("rel"), urls.published_href(urls.item_id(F.col("url"))).alias("href"))


@query
def tile_index(s, d):
    lon, lat = (F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2
    return _items(s, d).select("item_id", geo.tile_x(lon, 12).alias("x"), geo.tile_y(lat, 12).alias("y"), F.lit(12).alias("z"))


@query
def validate_report(s, d):
    documents = s.read.parquet(f"{d}/events.parquet").select(F.concat(F.lit("items/e-"), F.col("event_id").cast("string"), F.lit(".json")).alias("item_path"), _event_document().alias("body"))
    return validate.report(documents, "2026-01-01T00:00:00").select("item_id", "json_exists", "json_valid", F.when(F.col("validation_error").startswith("JSON"), "JSON decode error").otherwise(F.col("validation_error")).alias("error"))


def _event_document():
    """Item documents from events, with faults by event_id."""
    n = F.col("event_id")
    good = F.concat(
        F.lit('{"type":"'), F.when(n % 7 == 1, "Item").otherwise("Feature"), F.lit('","stac_version":"1.1.0","id":"e-'), n.cast("string"),
        F.lit('","geometry":{"type":"Polygon","coordinates":[[[1,0],[1,1],[0,1],[0,0],['), F.when(n % 11 == 2, "2").otherwise("1"), F.lit(',0]]]},"bbox":[0,0,1'), F.when(n % 13 == 3, "").otherwise(",1"),
        F.lit('],"properties":{"datetime":'), F.when(n % 5 == 4, '"soon"').otherwise('"2019-01-01T00:00:00Z"'), F.lit(',"k":'), F.get_json_object("props", "$.k"),
        F.lit('},"links":[{"rel":"collection","href":"c.json"}]'), F.when(n % 17 == 5, "").otherwise(',"collection":"elevation"'), F.lit(',"assets":{"image":{"href":"x.tif"}}}'),
    )
    return F.when(n % 19 == 6, F.lit(None)).when(n % 23 == 7, F.substring(good, 1, 60)).otherwise(good)


@query
def validate_by_schema(s, d):
    """The same documents by the rules as a schema, with the paths of all errors. Rows are dealt first, since few row groups would be few tasks for much work."""
    documents = s.read.parquet(f"{d}/events.parquet").select("event_id", "props").repartition("event_id").select("event_id", _event_document().alias("body"))
    return jsonschema.with_errors(documents, schema.ITEM_RULES).select("event_id", F.array_join(F.transform("errors", lambda e: F.concat_ws(" ", e["path"], e["keyword"])), ", ").alias("errors"))


@query
def validate_summary(s, d):
    return validate.summary(_report(s, d))


@query
def validate_incremental(s, d):
    documents = _report(s, d).select("item_path", "item_id")
    history = _report(s, d).where("item_id LIKE '%1' OR item_id LIKE '%2'")
    return validate.not_reported(documents, history).select("item_id")


@query
def validate_incremental_status(s, d):
    rows = _report(s, d)
    return validate.incremental_status(rows.where("item_id NOT LIKE '%2'"), rows.where("item_id LIKE '%2'"))


@query
def invalid_to_url_join(s, d):
    report = _reported(s, d)
    return items.repair_urls_exact(report, _inventory(s, d))


@query
def invalid_to_url_lossy(s, d):
    return items.repair_urls(_report(s, d))


def _probes(s, d):
    return fx.relation(s, d, fx.PROBES)


@query
def access_classify(s, d):
    return access.classify(_probes(s, d), "2026-01-01T00:00:00Z").withColumn("status_code", F.coalesce("status_code", F.lit(-1)))


@query
def access_delta(s, d):
    return access.to_check(_probes(s, d).select("url"), _probes(s, d).where("event_id % 3 = 0").select("url"))


@query
def access_exit_status(s, d):
    rows = access.classify(_probes(s, d), "2026-01-01T00:00:00Z")
    return access.exit_status(rows.where("url NOT LIKE '%2.tif'"), rows.where("url LIKE '%2.tif'"))


def _catalogs(s, d):
    return fx.relation(s, d, fx.LOCAL), fx.relation(s, d, fx.REMOTE)


@query
def qa_diff(s, d):
    found = qa.differences(*_catalogs(s, d))
    return found.select("name", "missing", F.array_join("differences", ",").alias("differences"))


@query
def qa_summary(s, d):
    return qa.summary(qa.differences(*_catalogs(s, d)))


@query
def qa_sample_size(s, d):
    local, _ = _catalogs(s, d)
    n = local.count()
    return s.range(1).select(F.lit(qa.sample_size(n)).cast("long").alias("size"), F.lit(qa.sample_size(n, 5, 200)).cast("long").alias("larger"))


@query
def qa_sampled(s, d):
    local, remote = _catalogs(s, d)
    return qa.check(local, remote, percent=5).select("name", "missing", F.array_join("differences", ",").alias("differences"))


@query
def search_bbox(s, d):
    return search.search(_items(s, d), bbox=list(BOX)).select("item_id")


@query
def search_datetime(s, d):
    return search.search(_items(s, d), collection="elevation", interval=INTERVAL).select("item_id", "datetime")


@query
def search_bbox_datetime(s, d):
    return search.search(_items(s, d), collection="elevation", bbox=list(BOX), interval=INTERVAL).select("item_id")


@query
def search_unknown_flag(s, d):
    return search.search(_items(s, d), bbox=list(BOX), datetime_unknown=True).select("item_id")


@query
def search_page(s, d):
    return search.page(search.search(_items(s, d), bbox=list(BOX)), 20, 40).select("item_id")


@query
def search_polygon(s, d):
    return search.search(_items(s, d), intersects=POLYGON).select("item_id")


@query
def search_named_area(s, d):
    area = search.named_areas(fx.relation(s, d, fx.AREAS), "NATION_3")
    return search.spatial_join(_items(s, d), area).select("item_id", "area_id")


@query
def spatial_join_grid(s, d):
    return search.spatial_join(_items(s, d), fx.relation(s, d, fx.AREAS))


@query
def spatial_join_counts(s, d):
    return spatial_join_grid(s, d).groupBy("area_id").agg(F.count("*").alias("items"))


@query
def spatial_join_polygons(s, d):
    at = lambda x, y: F.array(F.col("cx") + x * F.col("rx"), F.col("cy") + y * F.col("ry"))
    ring = F.array(at(1, 0), at(0, 1), at(-1, 0), at(0, -1), at(1, 0))
    return search.polygon_join(_items(s, d), fx.relation(s, d, fx.DIAMONDS).select("area_id", F.array(ring).alias("rings")))


@query
def geometry_forms(s, d):
    box = F.array(*(F.col(c) for c in search.BOX))
    ring = geo.box_ring(*(F.col(c) for c in search.BOX))
    wkt = F.concat(F.lit("POLYGON (("), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string"))), ", "), F.lit("))"))
    back = geo.ring_box(F.element_at(geo.parse_wkt_polygon(wkt), 1))
    return _items(s, d).select("item_id", *[F.element_at(back, k).alias(c) for k, c in enumerate(search.BOX, 1)], geo.format_ring(F.element_at(geo.box_polygon(box)["coordinates"], 1)).alias("text"), F.size(geo.box_line(box)["coordinates"]).alias("points"))


@query
def crs_forward(s, d):
    """Corners of boxes to UTM zone 10 and Albers, in centimetres' tenths."""
    lon, lat = F.col("west"), F.col("south")
    (x, y), (ax, ay) = geo.lonlat_to_utm(lon, lat, F.lit(-123.0)), geo.lonlat_to_albers(lon, lat)
    return _items(s, d).select("item_id", *[F.round(c, 3).alias(n) for n, c in (("x", x), ("y", y), ("albers_x", ax), ("albers_y", ay))])


@query
def crs_round_trip(s, d):
    """The same corners there and back."""
    lon, lat = F.col("west"), F.col("south")
    (x, y), (ax, ay) = geo.lonlat_to_utm(lon, lat, F.lit(-123.0)), geo.lonlat_to_albers(lon, lat)
    flat = _items(s, d).select("item_id", x.alias("x"), y.alias("y"), ax.alias("ax"), ay.alias("ay"))
    (blon, blat), (alon, alat) = geo.utm_to_lonlat(F.col("x"), F.col("y"), F.lit(-123.0)), geo.albers_to_lonlat(F.col("ax"), F.col("ay"))
    return flat.select("item_id", F.round(blon, 5).alias("lon"), F.round(blat, 5).alias("lat"), F.round(alon, 5).alias("albers_lon"), F.round(alat, 5).alias("albers_lat"))


def _structs(s, d):
    item = F.struct(F.col("item_id").alias("id"), F.create_map(F.lit("image"), F.struct(F.concat("item_id", F.lit(".tif")).alias("href")), F.lit("thumb"), F.struct(F.concat("item_id", F.lit(".png")).alias("href"))).alias("assets"))
    return _items(s, d).select(item.alias("item"))


@query
def pluck_asset_href(s, d):
    return search.asset_hrefs(_structs(s, d))


@query
def explode_assets(s, d):
    return search.all_assets(_structs(s, d))


@query
def json_props_get(s, d):
    props = F.from_json("props", "k int, absent string")
    return s.read.parquet(f"{d}/events.parquet").select("event_id", props["k"].alias("k"), F.coalesce(props["absent"], F.lit("none")).alias("absent"))


@query
def array_slice_concat(s, d):
    nine = geo.affine9(F.col("embedding").cast("array<double>"))
    return s.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.size(nine).alias("n"), F.element_at(nine, 1).alias("first"), F.element_at(nine, 6).alias("sixth"), F.element_at(nine, 9).alias("last"))


@query
def head_and_more(s, d):
    total = _inventory(s, d).count()
    head, more = changes.head_and_more(_inventory(s, d), 10, total)
    return head.select("ordinal", "url", F.lit(more).cast("long").alias("more"))


@query
def throughput_report(s, d):
    counts = changes.compare_listings(*_listings(s, d))
    return counts.select("fresh", changes.detection_rate(F.col("fresh"), F.lit(90.0)).alias("rate"), (F.col("fresh") - F.col("cached")).alias("delta"), F.round(F.col("fresh") / 650.0 / 60.0, 2).alias("minutes"))


@query
def links_by_rel(s, d):
    return collection.count_links(_item_links(s, d))


def _scratch(s, name):
    """A new path below the folder that driver and executors share."""
    found = s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()
    if not found:
        if not (s.sparkContext.master == "local" or s.sparkContext.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orolith-"))
        found = s.sparkContext.getCheckpointDir()
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def lines_written_and_read(s, d):
    path = _scratch(s, "lines")
    writers.write_lines(_inventory(s, d), path)
    return readers.nonblank(readers.read_lines(s, path)).select("url")


@query
def checks_written_and_read(s, d):
    path = _scratch(s, "checks")
    writers.rewrite_csv(_checks(s, d), path)
    return readers.read_checks(s, path).select("url", "is_geotiff", "is_cog", F.coalesce("epsg", F.lit(0)).alias("epsg"), F.coalesce("height", F.lit(0)).alias("height"), F.coalesce(F.element_at("bounds", 3), F.lit(0.0)).alias("right"), F.coalesce(F.size("transform"), F.lit(-1)).alias("terms"))


@query
def report_written_and_read(s, d):
    path = _scratch(s, "report")
    writers.rewrite_csv(_report(s, d), path)
    return readers.read_report(s, path)


@query
def access_written_and_read(s, d):
    path = _scratch(s, "access")
    writers.rewrite_csv(access.classify(_probes(s, d), "2026-01-01T00:00:00Z"), path)
    return readers.read_access(s, path).withColumn("status_code", F.coalesce("status_code", F.lit(-1)))


def _area_documents(s, d):
    return fx.relation(s, d, fx.AREAS).select(F.concat(F.lit("area-"), F.col("area_id").cast("string")).alias("item_id"), F.to_json(F.struct("name", "west")).alias("body"))


@query
def documents_written_and_read(s, d):
    path = _scratch(s, "documents")
    written = writers.export_documents(_area_documents(s, d), path)
    rows = readers.read_documents(s, path, "*-*.json").select("item_id", F.from_json("body", "name string, west double").alias("b"))
    return rows.select("item_id", "b.name", F.round("b.west", 6).alias("west"), F.lit(written).cast("long").alias("written"), F.lit(readers.count_json(s, path)).cast("long").alias("counted"))


@query
def json_lines_written_and_read(s, d):
    path = _scratch(s, "lines")
    writers.write_json_lines(items.item_documents(_built(s, d)), path)
    return s.read.schema("id string, collection string, properties struct<datetime: string>").json(path).select("id", "collection", "properties.datetime")


@query
def collection_written_and_read(s, d):
    """Items that a written collection's links name."""
    path = _scratch(s, "collection")
    links = _area_documents(s, d).select(F.monotonically_increasing_id().alias("ordinal"), F.lit("item").alias("rel"), urls.published_href(F.col("item_id")).alias("href"), F.lit("application/geo+json").alias("type"))
    collection.collection_document(collection.temporal_extent(_inventory(s, d)), links).select("body").write.text(path)
    read = readers.read_collection(s, path)
    return readers.collection_items(read, _area_documents(s, d).select(F.col("item_id").alias("id"), "body")).select("id", F.get_json_object("body", "$.name").alias("name"))


@query
def ledger_appended(s, d):
    path = _scratch(s, "ledger")
    run = changes.compare_listings(*_listings(s, d)).select("fresh", "cached", "exit_code")
    for number in (1, 2):
        writers.append_ledger(run.withColumn("run", F.lit(number)), path)
    return s.read.parquet(path)


@query
def saved_search(s, d):
    """A search result kept as a table and read again."""
    path = _scratch(s, "search")
    search.search(_items(s, d), bbox=list(BOX), interval=INTERVAL).select("item_id", "datetime").write.parquet(path)
    return s.read.parquet(path)


@query
def object_listing(s, d):
    """The inventory's names, kept as listings in five folders, each listed by a task of its own."""
    path = _scratch(s, "listings")
    _inventory(s, d).select("url", (F.col("ordinal") % 5).alias("part")).write.partitionBy("part").text(path)
    s.dataSource.register(adapters.ListingSource)
    prefixes = ",".join(f"{path}/part={k}" for k in range(5))
    rows = s.read.format("object_listing").option("prefixes", prefixes).option("lister", "orolith.plans.fixtures:listing").load()
    return rows.where(~urls.has_parenthesis(F.col("url")))


def _tree(s, d):
    """Documents below one root: regions, nations, customers and orders, whose documents name an item and the root again."""
    path = _scratch(s, "tree")
    root = f"{fx.TREE}/catalog.json"
    documents = fx.relation(s, d, "SELECT o_orderkey AS k FROM {t:orders}").select(
        F.format_string(f"{fx.TREE}/o%d/catalog.json", "k").alias("href"),
        F.to_json(F.struct(F.array(F.struct(F.lit("item").alias("rel"), F.format_string("./%d.json", "k").alias("href")), F.struct(F.lit("child").alias("rel"), F.lit("../catalog.json").alias("href"))).alias("links"))).alias("body"))
    links = fx.relation(s, d, fx.TREE_LINKS).unionByName(traverse.document_links(documents))
    return traverse.traverse(links, s.range(1).select(F.lit(root).alias("href")), path)


@query
def catalog_tree_nodes(s, d):
    return _tree(s, d)[0]


@query
def catalog_tree_items(s, d):
    return traverse.items_below(*_tree(s, d))


@query
def catalog_tree_back_links(s, d):
    return traverse.back_links(*_tree(s, d))


@query
def head_probes(s, d):
    """Probes by a function that stands for the network: every third address is missing, every seventh fails."""

    def head(url):
        n = int(url.rsplit("/", 1)[1].removesuffix(".tif"))
        if n % 7 == 0:
            raise OSError("timed out")
        return (404, "Not Found") if n % 3 == 0 else (200, "OK")

    return access.classify(adapters.head_probe(_probes(s, d), head), "now").withColumn("status_code", F.coalesce("status_code", F.lit(-1)))


@query
def raster_header_rows(s, d):
    """Headers by a function that stands for the raster library: one in five can't be opened."""

    def read(opened):
        n = len(opened)
        if n % 5 == 0:
            raise OSError("not a raster")
        return {"is_cog": n % 2 == 0, "epsg": 26910, "height": n, "width": 2 * n, "transform": (1.0, 0.0, float(n), 0.0, -1.0, 2.0, 0.0, 0.0, 1.0), "bounds": (0.0, 0.0, float(n), 1.0)}

    rows = adapters.raster_headers(_inventory(s, d), read)
    return rows.select("url", "is_geotiff", "is_cog", F.coalesce("epsg", F.lit(0)).alias("epsg"), F.coalesce("width", F.lit(0)).alias("width"), F.coalesce(F.size("transform"), F.lit(-1)).alias("terms"), F.coalesce(F.element_at("bounds", 3), F.lit(0.0)).alias("right"))


@query
def probe_texts(s, d):
    said = F.when(F.col("ordinal") % 3 == 0, f"ok: it {adapters.VALID_COG}").when(F.col("ordinal") % 3 == 1, f"it {adapters.NOT_COG}").when(F.col("ordinal") % 2 == 0, "no such file")
    return adapters.classify_probe_text(_inventory(s, d).select("url", said.alias("output")))


@query
def area_features(s, d):
    lines = collection.features(fx.relation(s, d, fx.AREAS), ["area_id", "name"])
    f = F.from_json("feature", "type string, properties struct<area_id: int, name: string>, geometry struct<type: string, coordinates: array<array<array<double>>>>")
    return lines.select(f.alias("f")).select("f.properties.*", F.col("f.geometry.type").alias("shape"), F.round(F.col("f.geometry.coordinates")[0][0][0], 6).alias("x"), F.round(F.col("f.geometry.coordinates")[0][1][1], 6).alias("y"), F.size(F.col("f.geometry.coordinates")[0]).alias("points"))


@query
def bounds_service_rows(s, d):
    def fetch(url):
        n = int(url.rsplit("/", 1)[1].removesuffix(".tif"))
        return (500, None) if n % 4 == 0 else (200, [float(n), 0.0, n + 1.0, 1.0])

    return adapters.bounds_probe(_probes(s, d), fetch).select("url", F.element_at("bounds", 1).alias("left"), F.element_at("bounds", 3).alias("right"))


def _catalog_rows(s, d):
    rows = fx.relation(s, d, fx.LOCAL).select("doc_id", "id", F.concat_ws("|", "datetime", F.col("datetime_unknown").cast("string")).alias("body"))
    return rows.where("doc_id % 3 <> 1").drop("doc_id"), rows.where("doc_id % 4 <> 2").select("id", F.when(F.col("doc_id") % 5 == 0, "old").otherwise(F.col("body")).alias("body"))


@query
def publish_plan(s, d):
    return publish.plan(*_catalog_rows(s, d), mirror=True).groupBy("action").agg(F.count("*").alias("n"))


@query
def publish_upsert(s, d):
    new, published = _catalog_rows(s, d)
    return publish.upsert(published, new)


@query
def published_catalog(s, d):
    """A catalog published twice, the second time as a mirror, then promoted."""
    new, published = _catalog_rows(s, d)
    path = _scratch(s, "catalog")
    about = s.range(1).select(F.lit("c").alias("id"))
    publish.publish(published, about, f"{path}/staged")
    publish.publish(new, about, f"{path}/staged", mirror=True)
    publish.promote(s, f"{path}/staged", f"{path}/production")
    return s.read.parquet(f"{path}/production/items")


@query
def qa_of_documents(s, d):
    """Comparison of whole item documents, absent keys and all."""
    n = F.col("doc_id")

    def side(lang, assets):
        props = F.struct(lang.alias("datetime"), F.when(n % 4 == 0, True).alias("datetime_unknown"))
        item = F.struct(n.cast("string").alias("id"), F.array(n).alias("geometry"), F.array(n, n).alias("bbox"), props.alias("properties"), assets.alias("assets"))
        return s.read.parquet(f"{d}/documents.parquet").select(n.cast("string").alias("name"), item.alias("item"))

    one = F.create_map(F.lit("image"), F.lit("a"))
    local = qa.compared_fields(side(F.col("lang"), one))
    remote = qa.compared_fields(side(F.when(n % 10 != 3, F.col("lang")), F.when(n % 6 == 5, F.create_map(F.lit("image"), F.lit("a"), F.lit("thumb"), F.lit("b"))).otherwise(one)))
    return qa.differences(local, remote).select("name", "missing", F.array_join("differences", ",").alias("differences"))


@query
def error_texts(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", urls.error_text("STAC validation error", F.col("text")).alias("error"), urls.log_name(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")), "build").alias("log"))


@query
def listing_windows(s, d):
    """URLs of a listing stream by day of event time."""
    path = _scratch(s, "windows")
    rows = _inventory(s, d).withColumn("listed_at", F.timestamp_seconds(F.lit(1_700_006_400) + (F.col("ordinal") % 5) * 86_400))
    rows.write.parquet(f"{path}/listing")
    counts = increments.listing_counts(increments.stream_listings(s, f"{path}/listing"))
    name = f"windows_{uuid.uuid4().hex}"
    counts.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return s.table(name).select(F.unix_timestamp("window.start").alias("day"), "urls")


@query
def stream_incremental_items(s, d):
    """Item rows of a listing read as a stream, two writes with an overlap, a batch each; the result is the batch's."""
    base = _scratch(s, "stream")
    rows = _inventory(s, d).withColumn("listed_at", F.timestamp_seconds(F.lit(1_700_000_000)))
    rows.where("ordinal % 2 = 0").write.parquet(f"{base}/listing")
    files = len(s.read.parquet(f"{base}/listing").inputFiles())
    rows.where("ordinal % 2 = 1 OR ordinal % 6 = 0").write.mode("append").parquet(f"{base}/listing")
    listing = increments.stream_listings(s, f"{base}/listing", files=max(files, 1))
    increments.maintain_items(listing, _checks(s, d), f"{base}/items", f"{base}/checkpoint").awaitTermination()
    return s.read.parquet(f"{base}/items").select("ordinal", "item_id", "status")
