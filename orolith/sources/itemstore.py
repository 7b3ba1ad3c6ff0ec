"""A store of items clustered in space, so that a search opens only files that can hold results.

Items are sorted by the Hilbert key of their box's centre and dealt by ranges of it to files. A
manifest keeps, for each file, the box around all its items, their range of time and their number.
A search first reads the manifest, then only the files whose box and times meet the question, and
filters their rows as search() does; Parquet's own statistics skip row groups within those files.

A store is written beside the one it replaces and renamed into place, so readers see one or the other.

Defined results: items without a box are kept, and found by searches that don't ask for a place; a store without
items gives none; repeated ids are rows of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolith.functions import curve
from orolith.operators import search
from orolith.sources import writers

#: Items of one file, about.
PER_FILE = 500_000
#: Items that one task sorts and cuts into files, about.
PER_TASK = 100_000
#: A search that meets more files than this scans the whole store, whose row groups its filters still skip; so the driver holds a bounded list.
MOST_FILES = 10_000
BOX = search.BOX


def write_store(items: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """Replaces the store at path by items (item_id, west, south, east, north, datetime and any others).

    Items at one place are split by their ids, so a place with a third of all items fills several files. A task writes several small files, so their number costs no tasks.
    """
    spark = items.sparkSession
    path = path.rstrip("/")
    staged = f"{path}.staged-{uuid.uuid4().hex[:8]}"
    keyed = items.withColumn("hilbert", curve.box_key(*(F.col(c) for c in BOX)))
    tasks = max(1, -(-items.count() // max(per_file, PER_TASK)))
    dealt = keyed.repartitionByRange(tasks, "hilbert", F.xxhash64("item_id")).sortWithinPartitions("hilbert")
    dealt.write.option("maxRecordsPerFile", per_file).parquet(f"{staged}/data")
    write_manifest(spark, staged)
    backup = writers.swap(spark, staged, path)
    if backup:
        writers.delete(spark, backup)


def write_manifest(spark: SparkSession, path: str) -> None:
    """A row for each file of a store: its name, number of items, outer box, and times."""
    rows = spark.read.parquet(f"{path}/data").withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    when = F.to_timestamp("datetime")
    outer = [F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north")]
    rows.groupBy("file").agg(F.count("*").alias("items"), *outer, F.min(when).alias("first"), F.max(when).alias("last")).coalesce(1).write.parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/manifest")


def meeting_files(spark: SparkSession, path: str, bbox: list[float] | None = None, interval: str | None = None) -> DataFrame:
    """The manifest's rows whose files can hold items of a box and an interval."""
    rows = manifest(spark, path)
    if bbox is not None:
        rows = search.in_box(rows, *bbox)
    if interval is not None:
        start, _, end = interval.partition("/")
        if start not in ("", ".."):
            rows = rows.where(F.col("last") >= F.to_timestamp(F.lit(start)))
        if (end or start) not in ("", ".."):
            rows = rows.where(F.col("first") <= F.to_timestamp(F.lit(end or start)))
    return rows


def read_store(spark: SparkSession, path: str, bbox: list[float] | None = None, interval: str | None = None) -> DataFrame:
    """The items of the files that can answer; their rows aren't filtered yet."""
    path = path.rstrip("/")
    whole = spark.read.parquet(f"{path}/data")
    if bbox is None and interval is None:
        return whole
    names = [r["file"] for r in meeting_files(spark, path, bbox, interval).select("file").limit(MOST_FILES + 1).collect()]
    if len(names) > MOST_FILES:
        return whole
    if not names:
        return whole.where(F.lit(False))
    return spark.read.schema(whole.schema).parquet(*[f"{path}/data/{n}" for n in names])


def search_store(spark: SparkSession, path: str, collection: str | None = None, bbox: list[float] | None = None, intersects: dict | None = None, interval: str | None = None, datetime_unknown: bool | None = None) -> DataFrame:
    """search() over a store: all conditions that are given, together."""
    near = search.envelope(intersects) if intersects is not None else bbox  # either box is one that every result meets
    rows = read_store(spark, path, near, interval)
    return search.search(rows, collection, bbox, intersects, interval, datetime_unknown).drop("hilbert")
