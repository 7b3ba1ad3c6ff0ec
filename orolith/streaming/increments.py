"""A streaming front-end: listings that arrive as files give the same items as a batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orolith import schema
from orolith.operators import items

#: The state has a row for each url seen, so it lies on the executors' disks and not in their heaps.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}
LISTING = T.StructType([T.StructField("ordinal", T.LongType()), T.StructField("url", T.StringType()), T.StructField("listed_at", T.TimestampType())])


def stream_listings(spark: SparkSession, path: str, files: int = 16) -> DataFrame:
    """Listing files (Parquet of LISTING) as a stream; a batch takes so many files, oldest first.

    Each batch of maintain_items() reads and shuffles the whole cache: batches should hold a fixed share of the listing, not a fixed number of files.
    """
    return spark.readStream.schema(LISTING).option("maxFilesPerTrigger", files).parquet(path)


def unseen(listing: DataFrame, delay: str = "400 days") -> DataFrame:
    """Each url once while the state holds it: until the watermark passes its last listing by delay."""
    return listing.withWatermark("listed_at", delay).dropDuplicatesWithinWatermark(["url"])


def listing_counts(listing: DataFrame, window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """URLs listed a window of event time; late rows count until the watermark."""
    return listing.withWatermark("listed_at", delay).groupBy(F.window("listed_at", window)).agg(F.count("*").alias("urls"))


def maintain_items(listing: DataFrame, checks: DataFrame, path: str, checkpoint: str, source: str = schema.SOURCE) -> StreamingQuery:
    """Appends item rows of urls not seen before to path, a folder a batch, so that a batch run again replaces its own rows.

    A checkpoint that has its state elsewhere keeps it there.
    """
    conf = listing.sparkSession.conf

    def merge(batch: DataFrame, number: int) -> None:
        items.resolve(batch.select("ordinal", "url"), checks, source).drop("transform", "bounds").write.mode("overwrite").parquet(f"{path}/batch={number}")

    before = {name: conf.get(name, None) for name in STATE}
    try:  # a query copies the session's settings when it starts
        for name, value in STATE.items():
            conf.set(name, value)
        return unseen(listing).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
