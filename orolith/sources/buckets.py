"""Tables in hash buckets, so that an upsert rewrites only the buckets that it changes.

A row's bucket is a hash of its key; each bucket is a partition folder. An upsert finds the rows that differ from those stored,
reads only their buckets, and writes these anew by dynamic partition overwrite: Spark stages the files and renames
them into place when all tasks are done. Buckets without a changed row keep their files, byte for byte. A run that fails before the
renames leaves the table as it was; one that fails between them leaves whole buckets of either version, and
the same upsert again completes it, since it finds what is still different.

Defined results: rows that repeat a key count as one, the one that is last by order (equal ones by a hash of the row); rows with a
null key are refused, since they couldn't be found again; an upsert without rows changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orolith.sources import writers

#: Rows of one bucket when a table is made, about.
PER_BUCKET = 1_000_000


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _hash(rows: DataFrame) -> Column:
    return F.xxhash64(*[F.to_json(f.name) if f.dataType.typeName() in ("map", "variant") else F.col(f.name) for f in rows.schema.fields])


def last_rows(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row of each key. A grouped maximum, combined before the shuffle, so a key with very many rows needs no sort."""
    by = F.struct(*([F.col(order)] if order else []), _hash(rows))
    return rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*rows.columns), by).alias("_row")).select("_row.*")


def layout(spark: SparkSession, path: str) -> tuple[str, int]:
    """A table's key and number of buckets."""
    found = spark.read.schema("key string, buckets int").json(f"{path.rstrip('/')}/layout").first()
    return found["key"], found["buckets"]


def _write(rows: DataFrame, path: str, buckets: int, mode: str) -> None:
    """A file for each bucket."""
    rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/data")


def create(rows: DataFrame, path: str, key: str, order: str | None = None, buckets: int | None = None) -> None:
    """Makes a table, replacing what was at path."""
    spark, path = rows.sparkSession, path.rstrip("/")
    _refuse_null_keys(rows, key)
    buckets = buckets or max(1, -(-rows.count() // PER_BUCKET))
    staged = writers.beside(path)
    _write(last_rows(rows, key, order).withColumn("bucket", bucket_of(key, buckets)), staged, buckets, "overwrite")
    spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.json(f"{staged}/layout")
    backup = writers.swap(spark, staged, path)
    if backup:
        writers.delete(spark, backup)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows."""
    return _stored(spark, path.rstrip("/")).drop("bucket")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/data")


def read_keys(spark: SparkSession, path: str, keys: list) -> DataFrame:
    """The rows of some keys, from their buckets alone."""
    path = path.rstrip("/")
    key, buckets = layout(spark, path)
    stored = _stored(spark, path)
    wanted = spark.createDataFrame([(k,) for k in keys], stored.select(key).schema)
    numbers = [r[0] for r in wanted.select(bucket_of(key, buckets)).distinct().collect()]
    return stored.where(F.col("bucket").isin(numbers)).join(wanted, key, "left_semi").drop("bucket")


def _refuse_null_keys(rows: DataFrame, key: str) -> None:
    if not rows.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"rows without {key}")


def upsert(changes: DataFrame, path: str, order: str | None = None, deleted: DataFrame | None = None) -> list[int]:
    """Puts rows in the place of those with their key, takes away the keys of deleted, and gives the numbers of the buckets rewritten.

    changes has the table's columns, deleted its key. A key in both stays, with its new row. Only the numbers of buckets come to the driver.
    """
    spark, path = changes.sparkSession, path.rstrip("/")
    key, buckets = layout(spark, path)
    _refuse_null_keys(changes, key)
    stored = _stored(spark, path)
    columns = [c for c in stored.columns if c != "bucket"]
    new = last_rows(changes.select(*columns), key, order).withColumn("bucket", bucket_of(key, buckets))
    numbers = lambda rows: [r[0] for r in rows.select("bucket").distinct().collect()]
    gone = (deleted.select(F.col(key)) if deleted is not None else changes.select(key).limit(0)).distinct().join(new.select(key), key, "left_anti").withColumn("bucket", bucket_of(key, buckets))
    met = stored.where(F.col("bucket").isin(numbers(new.select("bucket").unionByName(gone.select("bucket")))))
    kept = met.select("bucket", F.col(key).alias("_k"), _hash(stored.select(*columns)).alias("_h"))
    hashed = new.withColumn("_h", _hash(new.select(*columns)))
    fresh = hashed.join(kept, (hashed[key] == kept["_k"]) & (hashed["_h"] == kept["_h"]) & (hashed["bucket"] == kept["bucket"]), "left_anti").drop("_h")
    there = gone.join(kept, (gone[key] == kept["_k"]) & (gone["bucket"] == kept["bucket"]), "left_semi")
    touched = sorted(numbers(fresh.select("bucket").unionByName(there.select("bucket"))))
    if not touched:
        return []
    going = fresh.select(F.col(key).alias("_k")).unionByName(there.select(F.col(key).alias("_k")))
    rest = stored.where(F.col("bucket").isin(touched)).join(going, F.col(key) == F.col("_k"), "left_anti")
    left = rest.unionByName(fresh)
    emptied = set(touched) - set(numbers(left))
    if len(emptied) < len(touched):
        _write(left, path, buckets, "overwrite")
    for number in emptied:  # dynamic overwrite leaves a partition that gets no rows
        writers.delete(spark, f"{path}/data/bucket={number}")
    return touched
