"""Mixing sources to target weights by systematic sampling.

Every document of a source expects target / source size copies. The expected copies
are summed in a fixed order within the source, one random offset is added, and a
document is emitted once per integer boundary that its stretch crosses.

Documents are ordered by size class, then by hash bucket, then by size and id. So a
sample holds all sizes in proportion, and the ranks come in two steps (counts of
buckets, then rows of a bucket): no task needs all rows of a source.

Defined results: a null text has size 0; a null source is a source of its own, last;
sources without words get target 0 and no copies; repeated rows are documents of their
own; an empty table gives no rows; other columns pass through mix_documents unread, but for
such with the names of results, which results replace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

#: No source's target, and no document's words, exceed this many times its size.
MAX_COPIES = 3


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of sources from (source, size): (source, source_size, target).

    Weights 1, 2, 3 repeat over the sources by code point. Sources in ascending order of
    limit to weight are at their limit as long as an equal share by weight would exceed it,
    which is where repeated resharing ends. Works on one row a source.
    """
    by = Window.orderBy(F.asc_nulls_last("source"))
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", ((F.row_number().over(by) - 1) % 3 + 1).cast("long"))
    everything = Window.partitionBy(F.lit(1))
    before = Window.partitionBy(F.lit(1)).orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    cap = (F.col("source_size") * MAX_COPIES).cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    rows = rows.withColumn("cap", cap).withColumn("all_size", F.sum("source_size").over(everything).cast("decimal(38,0)")).withColumn("all_weight", F.sum("weight").over(everything))
    rows = rows.withColumn("rest_size", F.col("all_size") - F.coalesce(F.sum("cap").over(before), zero)).withColumn("rest_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("capped", F.col("cap").cast("double") * F.col("rest_weight") <= F.col("weight") * F.col("rest_size").cast("double"))
    held = lambda c: F.coalesce(F.sum(F.when(F.col("capped"), F.col(c))).over(everything), F.lit(0))
    share = F.col("weight").cast("double") * (F.col("all_size") - held("cap")).cast("double") / (F.col("all_weight") - held("weight")).cast("double")
    return rows.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix_documents(docs: DataFrame, seed: str = "mix", buckets: int = 64, keep_text: bool = True) -> DataFrame:
    """Adds size, source_size, target and copies to (doc_id, text, source, ...).

    buckets: hash buckets of each size class of a source. Reruns agree, as offset and order
    come from hashes of seed, source, doc_id and text. Without keep_text the text goes, and words are counted in one scan of the texts, the counts written.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "_tie").withColumn("_tie", F.xxhash64("text"))
    sized = docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    return sample_copies(sized if keep_text else materialize(sized.drop("text"), "sizes"), seed, buckets)


def sample_copies(sized: DataFrame, seed: str = "mix", buckets: int = 64) -> DataFrame:
    """mix_documents for rows that have their size; _tie, if there, orders rows that repeat an id, and goes."""
    sized = sized.drop("source_size", "target", "copies", "_class", "_bucket", "_s", "_c", "_b", "_ahead", "_u", "_rank", "_t")
    hexes = lambda c, n: F.conv(F.substring(F.md5(c), 1, n), 16, 10).cast("long")
    digits = F.length(F.bin("size"))
    sized = sized.withColumn("_class", (F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))") + digits * 16).cast("int")).withColumn("_bucket", (hexes(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 6) % buckets).cast("int"))
    counts = sized.groupBy("source", "_class", "_bucket").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    ahead = F.sum("n").over(Window.partitionBy("source").orderBy("_class", "_bucket")) - F.col("n")
    offset = (hexes(F.concat(F.lit(seed), F.coalesce("source", F.lit(""))), 5).cast("double")) / float(1 << 20)
    starts = counts.select(F.col("source").alias("_s"), F.col("_class").alias("_c"), F.col("_bucket").alias("_b"), ahead.alias("_ahead"), offset.alias("_u"))
    targets = source_targets(counts).withColumnRenamed("source", "_t")
    plan = starts.join(targets, F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    tie = ["_tie"] if "_tie" in sized.columns else []  # else rows that repeat an id could swap between runs
    within = F.row_number().over(Window.partitionBy("source", "_class", "_bucket").orderBy("size", "doc_id", *tie))
    ranked = sized.withColumn("_rank", within).join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")) & (F.col("_bucket") == F.col("_b")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = lambda k: F.floor(F.col("_u") + rate * k.cast("double"))
    at = F.col("_rank") + F.col("_ahead")
    return ranked.withColumn("copies", F.least(upto(at) - upto(at - 1), F.lit(MAX_COPIES)).cast("long")).drop("_class", "_bucket", "_s", "_c", "_b", "_ahead", "_u", "_rank", "_tie")
