"""URL access checks and their cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith.functions.urls import fix_scheme


def classify(probes: DataFrame, checked_at: str) -> DataFrame:
    """Cache rows of (url, status, reason, failure): accessible on status 200 only; a failure has no status."""
    failed = F.col("failure").isNotNull()
    ok = F.coalesce(F.col("status") == 200, F.lit(False)) & ~failed
    return probes.select("url", F.when(~failed, F.col("status")).alias("status_code"), ok.alias("accessible"), F.when(ok, "").when(failed, F.col("failure")).otherwise(F.coalesce("reason", F.lit(""))).alias("error"), F.lit(checked_at).alias("last_checked"))


def to_check(urls: DataFrame, cache: DataFrame, recheck: bool = False) -> DataFrame:
    """URLs that the cache lacks, or all of them."""
    return urls if recheck else urls.join(cache.select(F.col("url").alias("_u")), F.col("url") == F.col("_u"), "left_anti")


def merge(cache: DataFrame, checked: DataFrame, recheck: bool = False) -> DataFrame:
    """The cache after a run; a recheck replaces it."""
    return checked if recheck else cache.unionByName(checked)


def exit_status(cache: DataFrame, checked: DataFrame) -> DataFrame:
    """One row: checked, inaccessible, exit_code. With nothing checked, the whole cache decides, else the checked rows alone."""
    sides = cache.select("accessible", F.lit(0).alias("_new")).unionByName(checked.select("accessible", F.lit(1).alias("_new")))
    counts = sides.agg(F.count_if(F.expr("_new = 1")).alias("checked"), F.count_if(F.expr("NOT accessible AND _new = 1")).alias("_fresh"), F.count_if(F.expr("NOT accessible AND _new = 0")).alias("_old"))
    bad = F.when(F.col("checked") > 0, F.col("_fresh")).otherwise(F.col("_old"))
    return counts.select("checked", bad.alias("inaccessible"), F.when(bad > 0, 1).otherwise(0).alias("exit_code"))


def with_access(checks: DataFrame, cache: DataFrame) -> DataFrame:
    """Raster cache rows with their access rows; the raster cache's urls are as written, the other's are fixed."""
    return checks.join(cache.select(F.col("url").alias("_u"), "status_code", "accessible"), fix_scheme(F.col("url")) == F.col("_u"), "left").drop("_u")
