"""From inventory and raster cache to item rows, documents and collection links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orolith import schema
from orolith.functions import dates, geo, urls


def needs_upgrade(checks: DataFrame) -> DataFrame:
    """Cache rows that are readable but lack a transform, as rows of the old layout do."""
    return checks.where(F.col("is_geotiff") & F.col("transform").isNull())


def urls_to_check(inventory: DataFrame, checks: DataFrame) -> DataFrame:
    """Inventory rows the cache lacks or holds in the old layout. URLs compare as they are written."""
    state = checks.groupBy(F.col("url").alias("_url")).agg(F.bool_or(F.col("is_geotiff") & F.col("transform").isNull()).alias("_old"))
    return inventory.join(state, F.col("url") == F.col("_url"), "left").where("_url IS NULL OR _old").drop("_url", "_old")


def without_upgrading(checks: DataFrame, inventory: DataFrame) -> DataFrame:
    """Cache rows but those that an upgrade of the inventory will replace."""
    upgrading = needs_upgrade(checks).join(inventory.select(F.col("url").alias("_u")), F.col("url") == F.col("_u"), "left_semi").select(F.col("url").alias("_url")).distinct()
    return checks.join(upgrading, F.col("url") == F.col("_url"), "left_anti")


def merge_cache(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows then new ones; repetitions stay, the last counts on look-up."""
    return old.unionByName(new, allowMissingColumns=True)


def cache_lookup(checks: DataFrame) -> DataFrame:
    """One row a fixed url: the last by ordinal. A grouped maximum, so no sort and no window."""
    value = F.struct(*[c for c in checks.columns if c not in ("url", "ordinal")])
    return checks.groupBy(urls.fix_scheme(F.col("url")).alias("key")).agg(F.max_by(value, "ordinal").alias("check"))


def resolve(inventory: DataFrame, checks: DataFrame, source: str = schema.SOURCE, encode_href: bool = False) -> DataFrame:
    """Item rows of an inventory, a status each; no input fails the job.

    status: no_cache, unreadable, bad_date (an impossible day; row-at-a-time runs would
    void the batch, see batch_poisoned), needs_remote (no projection code), error (a date of 5
    to 7 digits or an unsupported projection), built.
    """
    # Everything that a url alone decides comes before the join: a filter on status then can't pull it apart and compute it again.
    keyed = dates.with_dates(inventory.withColumn("key", urls.fix_scheme(F.col("url")))).withColumn("item_id", urls.item_id(F.col("url"), source))
    rows = keyed.join(cache_lookup(checks), "key", "left").select("*", "check.*").drop("check")
    rows = rows.withColumn("href", urls.encode_spaces(F.col("key")) if encode_href else F.col("key"))
    status = (
        F.when(F.col("is_geotiff").isNull(), "no_cache").when(~F.col("is_geotiff"), "unreadable").when(F.col("date_error"), "bad_date")
        .when(F.col("epsg").isNull() | F.col("transform").isNull() | F.col("bounds").isNull(), "needs_remote")
        .when(F.col("datetime").isNull(), "error").when(~(geo.central_meridian(F.col("epsg")).isNotNull() | F.col("epsg").isin(3005, 4326)), "error").otherwise("built")
    )
    return rows.withColumn("status", status).drop("key")


def built_items(rows: DataFrame) -> DataFrame:
    """Built rows with bbox, geometry and projection fields."""
    built = geo.add_bounds(rows.where("status = 'built'"), "bounds", "epsg", "bbox")
    return built.withColumns({
        "geometry": geo.box_polygon(F.col("bbox")), "proj_geometry": geo.box_polygon(F.col("bounds")), "proj_transform": geo.affine9(F.col("transform")),
        "proj_shape": F.array("height", "width"), "media_type": urls.media_type(F.col("is_cog")),
    })


def item_documents(items: DataFrame, collection_id: str = schema.COLLECTION_ID, base: str = schema.PUBLISHED) -> DataFrame:
    """(ordinal, id, item struct, body JSON): null fields are left out of the JSON."""
    flag = F.when(F.col("datetime_unknown"), F.lit(True))
    item = F.struct(
        F.lit("Feature").alias("type"), F.lit(schema.STAC_VERSION).alias("stac_version"), F.array(F.lit(schema.PROJECTION_EXTENSION)).alias("stac_extensions"),
        F.col("item_id").alias("id"), "geometry", "bbox",
        F.struct(F.col("datetime"), flag.alias("datetime_unknown"), F.col("epsg").alias("proj:epsg"), F.col("proj_geometry").alias("proj:geometry"), F.col("bounds").alias("proj:bbox"), F.col("proj_shape").alias("proj:shape"), F.col("proj_transform").alias("proj:transform")).alias("properties"),
        F.array(F.struct(F.lit("collection").alias("rel"), F.lit(f"{base}/collection.json").alias("href"), F.lit("application/json").alias("type"))).alias("links"),
        F.lit(collection_id).alias("collection"),
        F.struct(F.struct("href", F.col("media_type").alias("type"), F.array(F.lit("data")).alias("roles")).alias("image")).alias("assets"),
    )
    return items.select("ordinal", F.col("item_id").alias("id"), item.alias("item")).withColumn("body", F.to_json("item"))


def status_metrics() -> list[Column]:
    """Aggregates over item rows: detected, and each status."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return [F.count("*").alias("detected"), *[count(s) for s in ("built", "no_cache", "unreadable", "bad_date", "needs_remote", "error")]]


def status_counts(rows: DataFrame) -> DataFrame:
    """One row: detected, each status, batch_poisoned (a bad day would void the batch), shortfall, gate_open (something was built)."""
    counts = rows.agg(*status_metrics())
    return counts.withColumns({"batch_poisoned": F.col("bad_date") > 0, "shortfall": F.col("detected") - F.col("built"), "gate_open": F.col("built") > 0})


def merge_links(existing: DataFrame, ids: DataFrame, base: str = schema.PUBLISHED, distinct: bool = False) -> DataFrame:
    """Candidate links (ordinal, href, added): only links there before the batch make a link skipped.

    distinct: a link that comes twice in the batch is added once.
    """
    batch = ids.select("ordinal", urls.published_href(F.col("item_id"), base).alias("href"))
    there = existing.where("rel = 'item'").select(F.col("href").alias("_href")).distinct()
    rows = batch.join(there, F.col("href") == F.col("_href"), "left").select("ordinal", "href", F.col("_href").isNull().alias("added"))
    if distinct:
        rows = rows.groupBy("href", "added").agg(F.min("ordinal").alias("ordinal")).select("ordinal", "href", "added")
    return rows


def link_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(F.count_if("added").alias("added"), F.count_if(F.expr("NOT added")).alias("skipped"))


def keep_links(links: DataFrame, mode: str, test: bool) -> DataFrame:
    """Links that a run starts from: a test run drops item links unless it is incremental."""
    return links.where("rel <> 'item'") if test and mode != "incremental" else links


def repair_urls(report: DataFrame, source: str = schema.SOURCE) -> DataFrame:
    """(item_id, url) of invalid report rows by the lossy inverse of ids."""
    return report.where("NOT json_valid").select("item_id", urls.url_from_id(F.col("item_id"), source).alias("url"))


def repair_urls_exact(report: DataFrame, inventory: DataFrame, source: str = schema.SOURCE) -> DataFrame:
    """(item_id, url) of invalid report rows by joining the inventory on its ids."""
    known = inventory.select(urls.item_id(F.col("url"), source).alias("_id"), "url").dropDuplicates(["_id", "url"])
    return report.where("NOT json_valid").join(known, F.col("item_id") == F.col("_id")).select("item_id", "url")
