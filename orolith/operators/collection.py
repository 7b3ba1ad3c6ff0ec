"""Extents and the collection document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith import schema
from orolith.functions import dates, geo


def temporal_extent(inventory: DataFrame) -> DataFrame:
    """One row: first and last path date (RFC 3339, null without any), dated, empty, bad_dates. Placeholder dates don't count."""
    at = dates.parse_date(F.col("date_text"))
    rows = dates.with_dates(inventory).withColumn("_at", at)
    return rows.agg(dates.rfc3339(F.min("_at")).alias("first"), dates.rfc3339(F.max("_at")).alias("last"), F.count("_at").alias("dated"), (F.count("_at") == 0).alias("empty"), F.count_if("date_error").alias("bad_dates"))


def bbox_union(items: DataFrame, bbox: str = "bbox") -> DataFrame:
    """One row: west, south, east, north of the envelope of all boxes; nulls are skipped; empty tells that none was left."""
    at = lambda k: F.element_at(bbox, k)
    return items.agg(F.min(at(1)).alias("west"), F.min(at(2)).alias("south"), F.max(at(3)).alias("east"), F.max(at(4)).alias("north"), (F.count(at(1)) == 0).alias("empty"))


def collection_document(extent: DataFrame, links: DataFrame | None = None, title: str = "Elevation rasters", description: str = "Elevation rasters by tile", license: str = "CC-BY-4.0", collection_id: str = schema.COLLECTION_ID, bbox: list[float] | None = None, base: str = schema.PUBLISHED) -> DataFrame:
    """One row (id, collection struct, body) from temporal_extent(); the spatial extent is a constant unless given.

    Links (ordinal, rel, href, type) go into the document in order: its format asks for them in one place.
    """
    own = F.array(F.struct(F.lit("self").alias("rel"), F.lit(f"{base}/collection.json").alias("href"), F.lit("application/json").alias("type")))
    rows = extent
    if links is not None:
        ordered = links.agg(F.sort_array(F.collect_list(F.struct("ordinal", "rel", "href", "type"))).alias("l")).select(F.transform("l", lambda x: F.struct(x["rel"].alias("rel"), x["href"].alias("href"), x["type"].alias("type"))).alias("_links"))
        rows = extent.withColumn("_k", F.lit(1)).join(ordered.withColumn("_k", F.lit(1)), "_k")
        own = F.concat(own, "_links")
    box = F.array(*[F.lit(v) for v in (bbox or schema.DEFAULT_EXTENT)])
    doc = F.struct(
        F.lit("Collection").alias("type"), F.lit(schema.STAC_VERSION).alias("stac_version"), F.lit(collection_id).alias("id"), F.lit(title).alias("title"), F.lit(description).alias("description"), F.lit(license).alias("license"),
        F.struct(F.struct(F.array(box).alias("bbox")).alias("spatial"), F.struct(F.array(F.array("first", "last")).alias("interval")).alias("temporal")).alias("extent"), own.alias("links"),
    )
    return rows.select(F.lit(collection_id).alias("id"), doc.alias("collection")).withColumn("body", F.to_json("collection"))


def count_links(links: DataFrame) -> DataFrame:
    """(rel, n) of links, a row each, or of a collection's array of them."""
    rows = links if "rel" in links.columns else links.select(F.explode("links").alias("l")).select("l.rel")
    return rows.groupBy("rel").agg(F.count("*").alias("n"))


def link_summary(links: DataFrame) -> DataFrame:
    """One row of links (ordinal, rel, href): links, item_links, first (href of the least ordinal), digest (the sum of 32 bits of each row's MD5)."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("ordinal").cast("string"), "rel", "href")), 1, 8), 16, 10).cast("long")
    return links.agg(F.count("*").alias("links"), F.count_if(F.col("rel") == "item").alias("item_links"), F.min_by("href", "ordinal").alias("first_href"), F.coalesce(F.sum(bits), F.lit(0)).alias("digest"))


def features(areas: DataFrame, properties: list[str]) -> DataFrame:
    """(feature) of rows with a box: GeoJSON features as text, a line each, whose sequence is a feature collection's content."""
    ring = geo.box_ring(*(F.col(c) for c in ("west", "south", "east", "north")))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return areas.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), shape.alias("geometry"))).alias("feature"))


def collection_errors(collection: DataFrame) -> DataFrame:
    """Rows of (id, errors): what the document lacks; an empty array is a valid one."""
    has = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))
    rules = {"type": F.col("type").eqNullSafe("Collection"), "stac_version": has("stac_version"), "id": has("id"), "description": has("description"), "license": has("license"), "spatial extent": F.coalesce(F.exists("extent.spatial.bbox", lambda b: F.size(b).isin(4, 6)), F.lit(False)), "temporal extent": F.coalesce(F.exists("extent.temporal.interval", lambda b: F.size(b) == 2), F.lit(False)), "links": F.col("links").isNotNull()}
    return collection.select("id", F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()])).alias("errors"))
