"""Publishing catalogs: add-only, mirrored, staged, and as upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolith.sources import writers


def preflight(items: DataFrame, collection: DataFrame) -> None:
    """Refuses to publish an empty catalog or one without its collection."""
    if items.isEmpty():
        raise ValueError("no items to publish")
    if collection.isEmpty():
        raise ValueError("no collection to publish")


def plan(items: DataFrame, published: DataFrame, mirror: bool = False) -> DataFrame:
    """(id, action): add, update, keep, and with mirror delete. What a dry run shows."""
    new = items.select("id", F.xxhash64("body").alias("h"))
    old = published.select(F.col("id").alias("_id"), F.xxhash64("body").alias("_h"))
    action = F.when(F.col("_id").isNull(), "add").when(F.col("id").isNull(), "delete").when(F.col("h") == F.col("_h"), "keep").otherwise("update")
    rows = new.join(old, F.col("id") == F.col("_id"), "full_outer").select(F.coalesce("id", "_id").alias("id"), action.alias("action"))
    return rows if mirror else rows.where("action <> 'delete'")


def upsert(published: DataFrame, items: DataFrame, mirror: bool = False) -> DataFrame:
    """Items, and unless they mirror the source the published ones that they don't replace."""
    if mirror:
        return items
    return published.join(items.select(F.col("id").alias("_id")), F.col("id") == F.col("_id"), "left_anti").unionByName(items)


def published_items(spark: SparkSession, path: str, kind: T.StructType) -> DataFrame:
    """The items of a catalog, none where it isn't there yet."""
    there = writers.exists(spark, f"{path}/items")
    return spark.read.schema(kind).parquet(f"{path}/items") if there else spark.createDataFrame([], kind)


def publish(items: DataFrame, collection: DataFrame, path: str, mirror: bool = False) -> dict[str, int]:
    """Items first, then the collection, each staged and renamed into place; gives counts by action."""
    spark: SparkSession = items.sparkSession
    preflight(items, collection)
    path = path[:-1] if path.endswith("/") else path
    published = published_items(spark, path, items.schema)
    counts = {r["action"]: r["n"] for r in plan(items, published, mirror).groupBy("action").agg(F.count("*").alias("n")).collect()}
    for name, rows in (("items", upsert(published, items, mirror)), ("collection", collection)):
        staged = f"{path}/.{name}.staged"
        rows.write.mode("overwrite").parquet(staged)
        backup = writers.swap(spark, staged, f"{path}/{name}")
        if backup:
            writers.delete(spark, backup)
    return counts


def promote(spark: SparkSession, staged: str, production: str) -> str | None:
    """Puts a staged catalog in place of production's and gives the backup's name; an empty one is refused."""
    if not writers.exists(spark, f"{staged}/items") or spark.read.parquet(f"{staged}/items").isEmpty():
        raise ValueError("the staged catalog is empty")
    return writers.swap(spark, staged, production)
