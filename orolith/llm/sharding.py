"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws -ln(u) / weight,
u from a hash of row and child, and the least draw wins, so children are taken in
proportion to their weights. A child's draw depends on nothing but the row, the child
and its weight: when weights change, rows move only into or out of the subtrees changed.

Defined results: a null doc_id hashes as an id of its own; a null text has no bytes;
repeated rows go to the same shard with slots of their own; an empty table gives no rows;
other columns pass through assign_shards. Equal texts (groups) are no unit here: doc_id decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = ("region", "rack", "shard")


def shard_tree(shards: int = 8, weights: dict[int, float] | None = None, block: int = 8) -> list[tuple[str, str, int, float]]:
    """Leaves (region, rack, shard, weight) for a number of shards.

    The first block of shards fills regions of two racks of two shards. Each shard beyond
    is a region of its own, so growing by one shard moves rows only into the new one.
    weights: of shards, 1 where not named.
    """
    leaves = []
    for s in range(shards):
        region, rack = (f"g{s // 4}", f"g{s // 4}k{s // 2 % 2}") if s < block else (f"x{s}", f"x{s}k0")
        leaves.append((region, rack, s, float((weights or {}).get(s, 1.0))))
    return leaves


def _children(tree: list[tuple[str, str, int, float]]) -> list[dict[str, dict[str, float]]]:
    """By level: the weights of the children of each node."""
    out: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for region, rack, shard, weight in tree:
        for level, (parent, child) in enumerate((("", region), (region, rack), (rack, str(shard)))):
            below = out[level].setdefault(parent, {})
            below[child] = below.get(child, 0.0) + weight
    return out


def place(key: Column, tree: list[tuple[str, str, int, float]]) -> Column:
    """The shard of a key: one weighted hash draw among the children a level."""
    node: Column = F.lit("")
    for below in _children(tree):
        options = F.create_map(*[x for parent, kids in below.items() for x in (F.lit(parent), F.array(*[F.struct(F.lit(w).alias("w"), F.lit(name).alias("name")) for name, w in kids.items()]))])
        u = lambda c: (F.conv(F.substring(F.md5(F.concat_ws("/", key, c["name"])), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
        draws = F.transform(F.element_at(options, node), lambda c: F.struct((-F.log(u(c)) / c["w"]).alias("draw"), c["name"].alias("name")))
        node = F.array_min(draws)["name"]
    return node.cast("int")


def assign_shards(docs: DataFrame, tree: list[tuple[str, str, int, float]], column: str = "shard") -> DataFrame:
    """Adds the shard of each row, from its doc_id."""
    return docs.withColumn(column, place(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), tree))


def number_slots(rows: DataFrame, buckets: int = 64) -> DataFrame:
    """Adds slot, gapless from 0 in each shard: rows are counted by hash bucket, then numbered inside each."""
    rows = rows.drop("slot", "_s", "_b", "_ahead", "_rank").withColumn("_bucket", (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, 6), 16, 10).cast("long") % buckets).cast("int"))
    counts = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("n"))
    starts = counts.select(F.col("shard").alias("_s"), F.col("_bucket").alias("_b"), (F.sum("n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("n")).alias("_ahead"))
    tie = [c for c in ("text_crc32", "size") if c in rows.columns] or [F.xxhash64("text")] * ("text" in rows.columns)  # rows that repeat an id keep their order
    within = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("doc_id", *tie)) - 1
    return rows.withColumn("_rank", within).join(starts, (F.col("shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b"))).withColumn("slot", (F.col("_rank") + F.col("_ahead")).cast("long")).drop("_s", "_b", "_ahead", "_rank", "_bucket")


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Writes all columns of docs, a folder a shard."""
    assign_shards(docs, shard_tree(shards)).write.partitionBy("shard").parquet(path)
