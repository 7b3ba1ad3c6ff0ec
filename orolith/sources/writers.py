"""Sinks: text lists, CSV caches, JSON documents, staged catalogs and ledgers.

Nothing overwrites a path that it reads: new content goes beside the old and is renamed into place.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def swap(spark: SparkSession, staged: str, path: str) -> str | None:
    """Renames staged to path; what was there is kept under the returned name."""
    fs, target = _fs(spark, path)
    backup = None
    if fs.exists(target):
        backup = f"{path.rstrip('/')}.before-{uuid.uuid4().hex[:8]}"
        fs.rename(target, _fs(spark, backup)[1])
    fs.rename(_fs(spark, staged)[1], target)
    return backup


def roll_back(spark: SparkSession, path: str, backup: str) -> None:
    """Puts a backup in place again."""
    delete(spark, path)
    fs, old = _fs(spark, backup)
    fs.rename(old, _fs(spark, path)[1])


def local_or_uri(spark: SparkSession, full: str) -> str:
    """A qualified path as pyarrow takes it, local ones without their scheme.

    On a cluster a local path is refused, since each executor would write to its own disk, unless it lies below a folder that the
    session shares: spark.checkpoint.dir or the warehouse.
    """
    if not full.startswith("file:"):
        return full
    plain = lambda path: re.sub("^file:/+", "/", path).rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        named = [spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir(), spark.conf.get("spark.sql.warehouse.dir", None)]
        shared = [plain(fs.makeQualified(p).toString()) for fs, p in (_fs(spark, x) for x in named if x)]
        if ".." in full.split("/") or not any(plain(full).startswith(f"{x}/") for x in shared):
            raise ValueError(f"{full} isn't a path that all executors share")
    return plain(full)


def beside(path: str) -> str:
    """A new path next to another."""
    return f"{path.rstrip('/')}.staged-{uuid.uuid4().hex[:8]}"


def write_lines(lines: DataFrame, path: str) -> None:
    """A bounded export: URLs in input order as one text file, replacing what was there. Larger lists stay Parquet.

    The list's format is a file of lines in order, so one task writes it. It copies ranges that other tasks have sorted and written, line by line, and sorts nothing itself.
    """
    spark, staged, ranges = lines.sparkSession, beside(path), beside(path)
    lines.repartitionByRange("ordinal").sortWithinPartitions("ordinal").select("url").write.text(ranges, lineSep="\n")
    fs, folder = _fs(spark, ranges)
    names = sorted(n for n in (f.getPath().getName() for f in fs.listStatus(folder)) if n.startswith("part-"))
    parts = [spark.read.text(f"{ranges}/{n}", lineSep="\n") for n in names] or [lines.select("url").limit(0)]
    reduce(DataFrame.union, parts).coalesce(1).write.text(staged, lineSep="\n")
    delete(spark, ranges)
    backup = swap(spark, staged, path)
    if backup:
        delete(spark, backup)


def write_lines_or_remove(lines: DataFrame, path: str) -> bool:
    """write_lines, but an empty result removes the path; tells whether there were rows."""
    if lines.isEmpty():
        delete(lines.sparkSession, path)
        return False
    write_lines(lines, path)
    return True


def json_arrays(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, for CSV."""
    return df.select(*[F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema.fields])


def rewrite_csv(df: DataFrame, path: str) -> None:
    """Replaces a CSV cache, also where df reads it."""
    staged = beside(path)
    json_arrays(df.drop("ordinal")).write.csv(staged, header=True, quote='"', escape='"')
    backup = swap(df.sparkSession, staged, path)
    if backup:
        delete(df.sparkSession, backup)


def write_json_lines(documents: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bodies as lines, the form in which catalogs are loaded elsewhere."""
    documents.select("body").write.mode(mode).text(path)


def export_documents(documents: DataFrame, path: str) -> int:
    """One <item_id>.json a row, written by the executors that hold the rows; gives the number of rows. A task that runs again replaces its own files.

    A path without a scheme is one of Hadoop's default file system, as for Spark's own writers. On a cluster local paths outside the shared folders are refused.
    """
    spark = documents.sparkSession
    fs, given = _fs(spark, path)
    path = local_or_uri(spark, re.sub("^s3[an]:", "s3:", fs.makeQualified(given).toString()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)
        store.create_dir(root, recursive=True)
        for b in batches:
            for item, body in zip(b.column("item_id").to_pylist(), b.column("body").to_pylist(), strict=True):
                with store.open_output_stream(f"{root.rstrip('/')}/{item}.json") as f:
                    f.write(f"{body or ''}\n".encode())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return documents.select("item_id", "body").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def append_ledger(rows: DataFrame, path: str) -> None:
    """Adds rows to an append-only table of runs."""
    rows.write.mode("append").parquet(path)
