"""The corpus pipeline: quality rules, SimHash near-dedup, mixing, packing.

run() applies STAGES to documents, each over all rows that the one before kept, written as
Parquet to the shared folder and read again.

Defined results, for every stage: nulls in any column, repeated rows and extra columns (also such
with the names of a stage's own columns) pass through as they are, and empty tables give no rows. Texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orolith.llm import mixing, packing, quality, simhash
from orolith.llm.common import materialize, table


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules or risk-controlled thresholds reject go.

    A null or empty text has no words and goes; equal rows share their verdict; a null language is a language of its own.
    """
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, similarity 0.8.

    The least doc_id stays, and a null one only where its group has no other; of rows that repeat that id one stays. Texts without words are a group.
    """
    return simhash.drop_near_duplicates(docs, similarity=0.8, words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them; those it doesn't take go.

    A null source is a source of its own; a text without words weighs nothing and comes as often as its place among the others gives; of equal rows each has a place of its own.
    """
    mixed = mixing.mix_documents(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("doc"))).where("copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 tokens, a row for each piece.

    A null or empty text is one token, the end; texts longer than a window run over several; repeated rows are packed each.
    """
    pieces = packing.pack_windows(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", filter_quality), ("near_dedup", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack)]

#: SQL has neither the binomial bounds nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
