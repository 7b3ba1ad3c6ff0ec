"""Traversal of catalogs whose documents link to each other.

The frontier is a relation: each round joins the links to the documents found last, drops
those found before, and writes what is new, so rounds number the depth of the catalog and
a cycle ends by itself. No document is visited twice, however many links lead to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith.functions.urls import add_target

LINKS = "struct<links: array<struct<rel: string, href: string>>>"


def document_links(documents: DataFrame) -> DataFrame:
    """(source, rel, href) of documents (href, body), as written; text that isn't JSON has none."""
    rows = documents.select(F.col("href").alias("source"), F.explode(F.from_json("body", LINKS)["links"]).alias("l"))
    return rows.select("source", "l.rel", "l.href")


def resolved_links(links: DataFrame) -> DataFrame:
    """(source, rel, target) of links (source, rel, href): addresses in full; links without one go."""
    return add_target(links, "source", "href", "target").select("source", "rel", "target")


def traverse(links: DataFrame, roots: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents reached from roots (href) over child links, as (href, depth) with the least depth, and the links used, both written below a new folder.

    A target without a document is reached like any other; dangling() tells those.
    """
    spark = links.sparkSession
    resolved_links(links).write.parquet(f"{folder}/links")
    held = spark.read.parquet(f"{folder}/links")
    children = held.where("rel = 'child'").select("source", F.col("target").alias("href"))
    level = lambda depth: spark.read.schema("href string").parquet(f"{folder}/levels/depth={depth}")
    reached = lambda: spark.read.schema("href string, depth int").parquet(f"{folder}/levels")
    depth = 0
    roots.select("href").where("href IS NOT NULL").distinct().write.parquet(f"{folder}/levels/depth=0")
    while not level(depth).isEmpty():
        found = children.join(level(depth).withColumnRenamed("href", "source"), "source", "left_semi").select("href").distinct()
        found.join(reached(), "href", "left_anti").write.parquet(f"{folder}/levels/depth={depth + 1}")
        depth += 1
    return reached(), held


def items_below(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(href, parent, depth) of each item link of the documents reached; an item that several link comes with each."""
    items = links.where("rel = 'item'").select(F.col("target").alias("item"), F.col("source").alias("href")).distinct()
    return items.join(nodes, "href").select(F.col("item").alias("href"), F.col("href").alias("parent"), (F.col("depth") + 1).alias("depth"))


def back_links(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(source, target) of child links that don't lead further down: a cycle has at least one."""
    children = links.where("rel = 'child'").select("source", "target").distinct()
    above = children.join(nodes.select(F.col("href").alias("source"), F.col("depth").alias("_from")), "source")
    return above.join(nodes.select(F.col("href").alias("target"), F.col("depth").alias("_to")), "target").where("_to <= _from").select("source", "target")


def dangling(nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """(href, depth) of what is reached but is no document."""
    return nodes.join(documents.select("href"), "href", "left_anti")
