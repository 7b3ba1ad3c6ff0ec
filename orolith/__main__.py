"""Command line: python -m orolith COMMAND. Exit codes: 0 nothing to report, 1 changes or faults found, 2 refused.

Fixed values: names of options and of collection.json, and which outcome gives which code, must be those that users' scripts expect.

Paths may be of any file system that Spark reads.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolith import schema
from orolith.functions import urls as names
from orolith.operators import access, changes, collection, publish, qa, validate
from orolith.plans import pipeline
from orolith.sources import adapters, readers, writers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="orolith", description="Catalogs of raster files")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, says: str, *needed: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=says)
        for option in needed:
            p.add_argument(f"--{option}", required=True)
        return p

    p = command("fetch", "list the rasters of an object store; writes their urls", "output")
    where = p.add_mutually_exclusive_group(required=True)
    where.add_argument("--folder", help="a folder of any file system that Spark reads")
    where.add_argument("--lister", help="module:function that gives the names below a prefix")
    p.add_argument("--prefixes", default="", help="comma-separated, one task each")
    p.add_argument("--test", action="store_true", help="keep a list that is there")
    command("detect", "compare a fresh listing with the cached one, as written; writes what is new and deleted, then replaces the cached one", "fresh", "cached", "new", "deleted")
    p = command("collection", "the collection document of a list of urls", "urls", "out")
    p.add_argument("--test", action="store_true", help="only the first urls, and item documents in the folder go")
    p.add_argument("--test-count", type=int, default=schema.TEST_COUNT)
    p = command("build", "item rows, documents, links and report of a list of urls", "urls", "checks", "out")
    p.add_argument("--mode", choices=("full", "incremental", "reprocess"), default="full", help="what the urls are: all, new ones, or those of invalid items")
    p.add_argument("--links", help="Parquet of the collection's links so far")
    p.add_argument("--test", action="store_true")
    p.add_argument("--test-count", type=int, default=schema.TEST_COUNT)
    p = command("validate", "check item documents; writes the report", "items-dir", "output")
    p.add_argument("--incremental", action="store_true", help="only items that the report lacks")
    p = command("extract-invalid", "urls of the report's invalid items, as a list for build --mode reprocess", "report", "output")
    p.add_argument("--source", default=schema.SOURCE)
    p = command("access", "probe urls; writes the results", "urls-file", "output", "head")
    p.add_argument("--recheck", action="store_true", help="also urls with a result")
    p.add_argument("--workers", type=int, default=16)
    p = command("reconcile", "urls of the list that no item backs", "urls", "items-dir")
    p.add_argument("--apply", action="store_true", help="keep only backed urls in the list")
    p = command("qa", "compare a sample of local items with another catalog", "local-dir", "remote-dir")
    p.add_argument("--sample-percent", type=float, default=schema.QA_PERCENT)
    p.add_argument("--max-items", type=int, default=schema.QA_MAX)
    p = command("publish", "add a folder's items, then its collection, to a catalog", "items-dir", "catalog")
    p.add_argument("--dryrun", action="store_true", help="only say what would change")
    p.add_argument("--mirror", action="store_true", help="items that the folder lacks leave the catalog")
    command("promote", "put a staged catalog in place of production's", "staged", "production")
    return top


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_documents(spark, folder, optional=True)


def fetch(spark: SparkSession, a: argparse.Namespace) -> int:
    """Writes the names that look like rasters, a repeated one once. An empty listing is refused and leaves the list."""
    if a.test and writers.exists(spark, a.output):
        return 0
    if a.folder:
        found = readers.read_listing(spark, a.folder)
    else:
        spark.dataSource.register(adapters.ListingSource)
        found = spark.read.format("object_listing").option("prefixes", a.prefixes).option("lister", a.lister).load()
    rasters = found.where(names.is_raster_name(F.col("url"))).distinct().sort("url")
    listed = rasters.select(F.monotonically_increasing_id().alias("ordinal"), "url")
    if listed.isEmpty():
        return 2
    writers.write_lines(listed, a.output)
    return 0


def detect(spark: SparkSession, a: argparse.Namespace) -> int:
    """Lists are compared as written. Where the guard doesn't refuse the fresh one, it becomes the cached one, so a second run finds nothing."""
    fresh, cached = readers.read_lines(spark, a.fresh), readers.read_lines(spark, a.cached, optional=True)
    status = changes.compare_listings(fresh, cached).first()
    print(status.asDict())
    if not status["refused"]:
        writers.write_lines_or_remove(changes.new_urls(fresh, cached), a.new)
        writers.write_lines_or_remove(changes.deleted_urls(fresh, cached), a.deleted)
        writers.write_lines(fresh, a.cached)
    return status["exit_code"]


def describe(spark: SparkSession, a: argparse.Namespace) -> int:
    """Writes collection.json, unless no url has a date."""
    if a.test:
        old = [p for p in readers.json_paths(spark, a.out) if not p.endswith("/collection.json")]
        for path in old:
            writers.delete(spark, path)
    rows = readers.read_lines(spark, a.urls)
    extent = collection.temporal_extent(changes.first_rows(rows, a.test_count) if a.test else rows)
    found = extent.first()
    print(found.asDict())
    if found["empty"]:
        return 1
    document = collection.collection_document(extent)
    writers.export_documents(document.select(F.lit("collection").alias("item_id"), "body"), a.out)
    return 0


def extract_invalid(spark: SparkSession, a: argparse.Namespace) -> int:
    """The report's rows marked invalid, in its order; without any the list stays as it is."""
    found = readers.invalid_ids(spark, a.report).select("ordinal", names.url_from_id(F.col("item_id"), a.source).alias("url"))
    if not found.isEmpty():
        writers.write_lines(found, a.output)
    return 0


def upload(spark: SparkSession, a: argparse.Namespace) -> int:
    """Refused without a collection or items; a dry run writes nothing."""
    documents = readers.read_documents(spark, a.items_dir, skip_collection=False, optional=True).select(F.col("item_id").alias("id"), "body")
    items, about = documents.where("id <> 'collection'"), documents.where("id = 'collection' AND length(trim(body)) > 0")
    try:
        publish.preflight(items, about)
        if a.dryrun:
            published = publish.published_items(spark, a.catalog, items.schema)
            print({r["action"]: r["n"] for r in publish.plan(items, published, a.mirror).groupBy("action").agg(F.count("*").alias("n")).collect()})
        else:
            print(publish.publish(items, about, a.catalog, a.mirror))
    except ValueError as refused:
        print(refused)
        return 2
    return 0


def build(spark: SparkSession, a: argparse.Namespace) -> int:
    urls = readers.read_lines(spark, a.urls)
    urls = pipeline.choose_inventory(urls, urls, urls, a.mode, a.test, a.test_count)
    links = spark.read.schema(schema.LINK).parquet(a.links) if a.links else spark.createDataFrame([], schema.LINK)
    out = a.out.rstrip("/")
    run, _ = pipeline.build_once(urls, readers.read_checks(spark, a.checks), links, f"{out}/rows", a.mode, a.test)
    for name in ("documents", "links", "report"):
        getattr(run, name).write.mode("overwrite").parquet(f"{out}/{name}")
    status = run.status.first()
    print(status.asDict())
    return 0 if status["gate_open"] else 1


def check_items(spark: SparkSession, a: argparse.Namespace) -> int:
    """No items are a fault; an increment with nothing new is none and leaves the report; else the whole report decides."""
    found, history = readers.read_documents(spark, a.items_dir, "*-*.json", optional=True), readers.read_report(spark, a.output)
    if found.isEmpty():
        return 1
    if a.incremental:
        found = validate.not_reported(found, history)
        if found.isEmpty():
            return 0
    report = validate.report(found.select("item_path", "body"))
    writers.rewrite_csv(validate.merge_reports(history, report) if a.incremental else report, a.output)
    status = validate.summary(readers.read_report(spark, a.output)).first()
    print(status.asDict())
    return status["exit_code"]


def probe(spark: SparkSession, a: argparse.Namespace) -> int:
    """The checked urls decide, the cache only where none was checked; a recheck forgets the cache. Each url is probed once, since results are written before they are counted."""
    urls, known = readers.trimmed(readers.read_lines(spark, a.urls_file)), readers.read_access(spark, a.output)
    module, function = a.head.split(":")
    head = getattr(importlib.import_module(module), function)
    if a.recheck:
        known = known.limit(0)
    wanted = access.to_check(urls.select("url").distinct(), known.select("url"))
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()[0]
    staged = writers.beside(a.output)
    access.classify(adapters.head_probe(wanted, head, a.workers), now).write.parquet(staged)
    checked = spark.read.parquet(staged).select(*known.columns)
    status = access.exit_status(known, checked).first()
    if status["checked"]:
        writers.rewrite_csv(access.merge(known, checked, a.recheck), a.output)
    writers.delete(spark, staged)
    print(status.asDict())
    return status["exit_code"]


def reconcile(spark: SparkSession, a: argparse.Namespace) -> int:
    urls, found = readers.read_lines(spark, a.urls), _documents(spark, a.items_dir).select("item_id")
    counts = changes.reconcile_counts(urls, found).first()
    print(counts.asDict())
    if a.apply:
        if not counts["backed"]:
            return 2
        writers.write_lines(changes.backed_urls(urls, found), a.urls)
    return 1 if counts["orphaned"] else 0


def compare(spark: SparkSession, a: argparse.Namespace) -> int:
    side = lambda folder: qa.compared_fields(_documents(spark, folder).select(F.col("item_id").alias("name"), F.from_json("body", schema.ITEM).alias("item")))
    status = qa.summary(qa.check(side(a.local_dir), side(a.remote_dir), a.sample_percent, a.max_items)).first()
    print(status.asDict())
    return 0 if status["passed"] else 1


def promote(spark: SparkSession, a: argparse.Namespace) -> int:
    try:
        print({"backup": publish.promote(spark, a.staged, a.production)})
    except ValueError as refused:
        print(refused)
        return 2
    return 0


COMMANDS = {
    "fetch": fetch, "detect": detect, "collection": describe, "build": build, "validate": check_items, "extract-invalid": extract_invalid, "access": probe,
    "reconcile": reconcile, "qa": compare, "publish": upload, "promote": promote,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    return COMMANDS[a.command](spark or SparkSession.builder.appName("orolith").getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
