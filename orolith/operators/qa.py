"""Comparison of two catalogs, whole or over a sample of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith import schema

FIELDS = ("id", "datetime", "datetime_unknown", "geometry", "bbox", "asset_count")


def compared_fields(items: DataFrame) -> DataFrame:
    """(name, exists, FIELDS) of items (name, item struct); absent keys are null and equal each other."""
    prop = lambda c: F.col(f"item.properties.`{c}`")
    kind = items.schema["item"].dataType["assets"].dataType.typeName()
    assets = F.coalesce(F.size("item.assets"), F.lit(0)) if kind == "map" else F.when(F.col("item.assets").isNull(), 0).otherwise(len(items.schema["item"].dataType["assets"].dataType))
    return items.select("name", F.col("item.id").alias("id"), prop("datetime").alias("datetime"), prop("datetime_unknown").alias("datetime_unknown"), F.col("item.geometry").alias("geometry"), F.col("item.bbox").alias("bbox"), assets.alias("asset_count"))


def differences(local: DataFrame, remote: DataFrame) -> DataFrame:
    """(name, missing, differences) for each local name; a missing remote is an error and no difference.

    local, remote: (name, FIELDS). The order of differences is that of FIELDS.
    """
    other = remote.select(F.col("name").alias("_name"), *[F.col(f).alias(f"_{f}") for f in FIELDS])
    found = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in FIELDS]))
    missing = F.col("_name").isNull()
    return local.join(other, F.col("name") == F.col("_name"), "left").select("name", missing.alias("missing"), F.when(missing, F.array().cast("array<string>")).otherwise(found).alias("differences"))


def summary(compared: DataFrame) -> DataFrame:
    """One row: checked, different, errors, passed."""
    counts = compared.agg(F.count_if(F.expr("NOT missing")).alias("checked"), F.count_if(F.size("differences") > 0).alias("different"), F.count_if("missing").alias("errors"))
    return counts.withColumn("passed", (F.col("different") == 0) & (F.col("errors") == 0))


def sample_size(total: int, percent: float = schema.QA_PERCENT, most: int = schema.QA_MAX, at_least_one: bool = True) -> int:
    """Rows of a sample; at_least_one also where there are none, unless it is False."""
    if not at_least_one and not total:
        return 0
    return max(1, min(int(total * percent / 100), most))


def sample(items: DataFrame, percent: float = schema.QA_PERCENT, most: int = schema.QA_MAX, seed: int = 0) -> DataFrame:
    """Exactly sample_size() rows without replacement, the least by MD5 of name and seed: reruns agree."""
    return items.orderBy(F.md5(F.concat_ws("/", "name", F.lit(str(seed)))), "name").limit(sample_size(items.count(), percent, most))


def check(local: DataFrame, remote: DataFrame, percent: float = schema.QA_PERCENT, most: int = schema.QA_MAX, seed: int = 0) -> DataFrame:
    """differences() over a sample of local names."""
    return differences(sample(local, percent, most, seed), remote)
