"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where the setting is absent and Spark runs in one process (tests), a temporary folder is made
    once and set, so that later calls agree on it; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        found = tempfile.mkdtemp(prefix="orolith-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def materialize(df: DataFrame, name: str = "t", compression: str = "snappy", rows: int = 0) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back, which cuts its lineage.

    Unlike local checkpoints the files outlive executors; unlike caching they need no memory.
    rows: most rows of a file, for rows of megabytes (0: as Spark does). Readers hold up to 4096 rows of a file at once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).option("maxRecordsPerFile", rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_files(df: DataFrame) -> None:
    """Deletes the files of a DataFrame that materialize() made."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Reduces links (a[i], b[i]) to one link from each node to the least node it reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        least = np.minimum(root[u], root[v])
        np.minimum.at(root, u, least)
        np.minimum.at(root, v, least)
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): (node, component), the least node reachable.

    Alternates large-star and small-star steps until no edge changes. Every step is a
    grouped minimum (combined before the shuffle) and an equi-join, which adaptive
    execution can split, so a hub needs no task of its own; each step's edges are
    written to the shared folder. Nodes without an edge to another node don't appear.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    seen = None
    while True:
        both = now.union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m").alias("y")), F.struct(F.col("a").alias("x"), F.col("m").alias("y")))).alias("e"))
        after = materialize(small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct(), "cc")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_files(now)
        now = after
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = mark
