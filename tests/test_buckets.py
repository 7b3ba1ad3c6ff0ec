"""Bucketed tables: what an upsert changes, and what it leaves."""

import pytest
from pyspark.sql import functions as F

from orolith.sources import buckets


def rows(spark, some):
    return spark.createDataFrame([(k, v, [v]) for k, v in some], "key string, n long, list array<long>")


def content(spark, path):
    found = buckets.read(spark, path).collect()
    assert all(r["list"] == [r["n"]] for r in found) and len({r["key"] for r in found}) == len(found)
    return {r["key"]: r["n"] for r in found}


def files(spark, path):
    return {(r[0].split("bucket=")[1].split("/")[0], r[0]) for r in spark.read.parquet(f"{path}/data").select(F.input_file_name()).distinct().collect()}


def test_one_changed_row_rewrites_one_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.create(rows(spark, [(f"k{i}", i) for i in range(500)]), path, "key", buckets=8)
    before = files(spark, path)
    assert len(before) == 8
    touched = buckets.upsert(rows(spark, [("k7", -7)] + [(f"k{i}", i) for i in range(100, 300)]), path)
    after = files(spark, path)
    assert len(touched) == 1 and len(before & after) == 7 and {b for b, _ in after - before} == {str(touched[0])}
    assert content(spark, path) == {f"k{i}": -7 if i == 7 else i for i in range(500)}
    assert buckets.upsert(rows(spark, [("k7", -7)]), path) == [] and files(spark, path) == after  # the same again
    assert [r["n"] for r in buckets.read_keys(spark, path, ["k7", "nowhere"]).collect()] == [-7]
    assert len(buckets.read_keys(spark, path, ["k7"]).inputFiles()) <= 8


def test_repeated_keys_deletions_and_emptied_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.create(rows(spark, [("a", 1), ("a", 3), ("a", 2), ("b", 1)]), path, "key", order="n", buckets=64)
    assert content(spark, path) == {"a": 3, "b": 1}
    gone = spark.createDataFrame([("b",), ("b",), ("never",), ("c",)], "key string")
    touched = buckets.upsert(rows(spark, [("c", 5), ("c", 9), ("c", 7)]), path, order="n", deleted=gone)
    assert content(spark, path) == {"a": 3, "c": 9} and len(touched) == 2
    assert buckets.upsert(rows(spark, []), path, deleted=spark.createDataFrame([("a",)], "key string")) and content(spark, path) == {"c": 9}
    assert buckets.upsert(rows(spark, []), path) == []
    with pytest.raises(ValueError, match="rows without key"):
        buckets.upsert(rows(spark, [(None, 1)]), path)
    assert content(spark, path) == {"c": 9}


def test_a_failed_upsert_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.create(rows(spark, [(f"k{i}", i) for i in range(50)]), path, "key", buckets=4)
    before = files(spark, path)
    broken = rows(spark, [("k1", -1), ("x", 0)]).withColumn("n", F.when(F.col("key") == "x", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        buckets.upsert(broken, path)
    assert files(spark, path) == before and content(spark, path) == {f"k{i}": i for i in range(50)}
