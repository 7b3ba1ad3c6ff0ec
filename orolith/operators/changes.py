"""Change detection between listings, caches and items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith import schema
from orolith.functions.urls import fix_scheme, item_id


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct urls of left that right lacks, with the ordinal of their first occurrence; nulls equal each other."""
    first = left.groupBy("url").agg(F.min("ordinal").alias("ordinal"))
    gone = right.select(F.col("url").alias("_url")).distinct()
    return first.join(gone, F.col("url").eqNullSafe(F.col("_url")), "left_anti").select("ordinal", "url")


def new_urls(fresh: DataFrame, cached: DataFrame) -> DataFrame:
    return set_difference(fresh, cached)


def deleted_urls(fresh: DataFrame, cached: DataFrame) -> DataFrame:
    return set_difference(cached, fresh)


def unchanged_count(fresh: DataFrame, cached: DataFrame) -> DataFrame:
    """One row: unchanged, the number of distinct urls of both."""
    return fresh.select("url").intersect(cached.select("url")).agg(F.count("*").alias("unchanged"))


def compare_listings(fresh: DataFrame, cached: DataFrame) -> DataFrame:
    """One row of counts, guard and exit code, from one full outer grouping of both lists.

    The guard refuses a listing below SHRINK_GUARD of a non-empty cache, duplicates counted.
    exit_code: 2 refused, 1 changes, 0 none.
    """
    sides = fresh.select("url", F.lit(1).alias("f"), F.lit(0).alias("c")).unionAll(cached.select("url", F.lit(0), F.lit(1)))
    by_url = sides.groupBy("url").agg(F.sum("f").alias("f"), F.sum("c").alias("c"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    counts = by_url.agg(total("f").alias("fresh"), total("c").alias("cached"), F.count_if(F.expr("f > 0 AND c = 0")).alias("new"), F.count_if(F.expr("f = 0 AND c > 0")).alias("deleted"), F.count_if(F.expr("f > 0 AND c > 0")).alias("unchanged"))
    refused = (F.col("cached") > 0) & (F.col("fresh") < F.col("cached") * F.lit(schema.SHRINK_GUARD))
    changed = (F.col("new") > 0) | (F.col("deleted") > 0)
    return counts.withColumns({"refused": refused, "changed": changed, "exit_code": F.when(refused, 2).when(changed, 1).otherwise(0)})


def backed_urls(inventory: DataFrame, report: DataFrame, source: str = schema.SOURCE) -> DataFrame:
    """Inventory rows whose id is in the report, valid or not; repetitions stay, blank lines go."""
    return _by_report(inventory, report, source, "left_semi")


def orphaned_urls(inventory: DataFrame, report: DataFrame, source: str = schema.SOURCE) -> DataFrame:
    """Inventory rows whose id isn't in the report."""
    return _by_report(inventory, report, source, "left_anti")


def _by_report(inventory: DataFrame, report: DataFrame, source: str, kind: str) -> DataFrame:
    ids = report.select(F.col("item_id").alias("_id"))
    lines = inventory.where(F.trim("url") != "").withColumn("item_id", item_id(F.col("url"), source))
    return lines.join(ids, F.col("item_id") == F.col("_id"), kind)


def reconcile_counts(inventory: DataFrame, report: DataFrame, source: str = schema.SOURCE) -> DataFrame:
    """One row: total, backed, orphaned."""
    ids = report.select(F.col("item_id").alias("_id")).distinct()
    lines = inventory.where(F.trim("url") != "").select(item_id(F.col("url"), source).alias("item_id"))
    return lines.join(ids, F.col("item_id") == F.col("_id"), "left").agg(F.count("*").alias("total"), F.count("_id").alias("backed"), F.count_if(F.expr("_id IS NULL")).alias("orphaned"))


def missing_from(rows: DataFrame, cache: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key a cache lacks, repetitions kept."""
    return rows.join(cache.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_anti")


def first_rows(rows: DataFrame, count: int = schema.TEST_COUNT) -> DataFrame:
    """The first rows in input order."""
    return rows.orderBy("ordinal").limit(count)


def head_and_more(rows: DataFrame, count: int, total: int | None = None) -> tuple[DataFrame, int]:
    """The first rows, and how many more there are."""
    total = rows.count() if total is None else total
    return first_rows(rows, count), max(total - count, 0)


def normalized(rows: DataFrame) -> DataFrame:
    return rows.withColumn("url", fix_scheme(F.col("url")))


def detection_rate(files: F.Column, seconds: F.Column) -> F.Column:
    """Files a second with one decimal."""
    return F.round(files / seconds, 1)
