"""Whole runs: full build, increment and reprocessing, as plans over DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orolith import schema
from orolith.operators import changes, items, validate


@dataclass
class Run:
    """What a run makes; nothing is written until a caller does, so a run that fails persists nothing."""

    rows: DataFrame
    documents: DataFrame
    links: DataFrame
    report: DataFrame
    status: DataFrame


def choose_inventory(inventory: DataFrame, new: DataFrame | None = None, invalid: DataFrame | None = None, mode: str = "full", test: bool = False, count: int = schema.TEST_COUNT) -> DataFrame:
    """The rows that a mode works on: reprocess before incremental before full; a test run takes the first rows."""
    rows = invalid if mode == "reprocess" else new if mode == "incremental" else inventory
    if rows is None:
        raise ValueError(f"mode {mode} needs its list of urls")
    return changes.first_rows(rows, count) if test else rows


def build(inventory: DataFrame, checks: DataFrame, existing_links: DataFrame, mode: str = "full", test: bool = False, source: str = schema.SOURCE, base: str = schema.PUBLISHED) -> Run:
    """Item rows, documents, collection links and report of an inventory."""
    return _parts(items.resolve(inventory, checks, source), existing_links, mode, test, base)


def build_once(inventory: DataFrame, checks: DataFrame, existing_links: DataFrame, path: str, mode: str = "full", test: bool = False, source: str = schema.SOURCE, base: str = schema.PUBLISHED) -> tuple[Run, dict[str, int]]:
    """build() with the item rows written to a path, replacing what was there, and their counts by status.

    The plan that resolves rows runs once: the counts are observed while it writes, and all parts of the run read what was written. The observed node lies in the last stage,
    whose tasks count once each however often they run.
    """
    seen = Observation()
    items.resolve(inventory, checks, source).observe(seen, *items.status_metrics()).write.mode("overwrite").parquet(path)
    run = _parts(inventory.sparkSession.read.parquet(path), existing_links, mode, test, base)
    return run, dict(seen.get)


def _parts(rows: DataFrame, existing_links: DataFrame, mode: str, test: bool, base: str) -> Run:
    built = items.built_items(rows)
    documents = items.item_documents(built, base=base)
    links = items.merge_links(items.keep_links(existing_links, mode, test), built.select("ordinal", "item_id"), base)
    paths = documents.select(F.concat("id", F.lit(".json")).alias("item_path"), "body")
    return Run(rows, documents, links, validate.report(paths), items.status_counts(rows))


def increment(fresh: DataFrame, cached: DataFrame, checks: DataFrame, history: DataFrame, existing_links: DataFrame, **options) -> tuple[DataFrame, Run]:
    """Change detection, then a build of what is new; the report is history and the new rows.

    Gives the status row of the detection and the run. Where the guard refused, the run is empty.
    """
    status = changes.compare_listings(fresh, cached)
    refused = status.select("refused").first()[0]
    new = changes.new_urls(fresh, cached)
    run = build(new.limit(0) if refused else new, checks, existing_links, mode="incremental", **options)
    fresh_only = validate.not_reported(run.documents.select(F.concat("id", F.lit(".json")).alias("item_path"), "body"), history)
    run.report = validate.merge_reports(history, validate.report(fresh_only))
    return status, run
