"""Edges to the network: listing, HEAD probes and raster headers.

Each takes the function that does the I/O, so nothing here needs a library of its own;
Spark spreads the calls over partitions. What the answers mean is plain column logic in
the operators.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from orolith.functions.urls import encode_spaces, fix_scheme


def head_probe(urls: DataFrame, head: Callable[[str], tuple[int, str]], partitions: int = 16) -> DataFrame:
    """(url, status, reason, failure) of each url. head gives status and reason, or raises."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url in b["url"]:
                try:
                    status, reason = head(url)
                    rows.append((url, status, reason, None))
                except Exception as error:  # noqa: BLE001 - any failure is a row
                    rows.append((url, None, None, str(error)))
            yield pd.DataFrame(rows, columns=["url", "status", "reason", "failure"]).astype({"status": "Int32"})

    return urls.select("url").repartition(partitions).mapInPandas(run, "url string, status int, reason string, failure string")


def raster_headers(urls: DataFrame, read: Callable[[str], dict], partitions: int = 32) -> DataFrame:
    """Rows of the raster cache for urls; a raster that read cannot open is unreadable, and cached so.

    read gets the encoded URL and gives is_cog, epsg, height, width, transform, bounds.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url, opened in zip(b["url"], b["opened"], strict=True):
                try:
                    h = read(opened)
                    rows.append((url, True, bool(h["is_cog"]), h.get("epsg"), h.get("height"), h.get("width"), list(h["transform"])[:6], list(h["bounds"])))
                except Exception:  # noqa: BLE001 - any failure is a row
                    rows.append((url, False, False, None, None, None, None, None))
            frame = pd.DataFrame(rows, columns=["url", "is_geotiff", "is_cog", "epsg", "height", "width", "transform", "bounds"])
            yield frame.astype({"epsg": "Int32", "height": "Int32", "width": "Int32"})

    opened = urls.select("url", encode_spaces(fix_scheme(F.col("url"))).alias("opened")).repartition(partitions)
    return opened.mapInPandas(run, "url string, is_geotiff boolean, is_cog boolean, epsg int, height int, width int, transform array<double>, bounds array<double>")


# What the probing tool says of a raster.
VALID_COG, NOT_COG = "is a valid cloud optimized GeoTIFF", "is NOT a valid cloud optimized GeoTIFF"


def classify_probe_text(probed: DataFrame) -> DataFrame:
    """(url, is_geotiff, is_cog) from what a probing tool printed (url, output): the layout of three columns. Output without either phrase is no raster."""
    says = lambda phrase: F.coalesce(F.contains("output", F.lit(phrase)), F.lit(False))
    return probed.select("url", (says(VALID_COG) | says(NOT_COG)).alias("is_geotiff"), says(VALID_COG).alias("is_cog"))


def bounds_probe(urls: DataFrame, fetch: Callable[[str], tuple[int, list[float] | None]]) -> DataFrame:
    """(url, bounds) from a bounds service; answers other than 200 are dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(url, *fetch(url)) for url in b["url"]]
            yield pd.DataFrame([(u, box) for u, status, box in found if status == 200], columns=["url", "bounds"])

    return urls.select("url").mapInPandas(run, "url string, bounds array<double>")


class _Prefix(InputPartition):
    def __init__(self, prefix: str):
        self.prefix = prefix


class ListingSource(DataSource):
    """spark.read.format("object_listing"): URLs of an object store, one partition a prefix.

    Options: prefixes (comma-separated), lister (module:function that gives the names below a prefix).
    """

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return "url string"

    def reader(self, schema) -> "ListingReader":
        return ListingReader(self.options)


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.prefixes = [p for p in options.get("prefixes", "").split(",")]
        self.lister = options["lister"]

    def partitions(self) -> list[InputPartition]:
        return [_Prefix(p) for p in self.prefixes]

    def read(self, partition: _Prefix) -> Iterator[tuple]:
        import importlib

        module, function = self.lister.split(":")
        for name in getattr(importlib.import_module(module), function)(partition.prefix):
            yield (name,)
