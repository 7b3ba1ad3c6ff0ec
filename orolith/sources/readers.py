"""Scans: text lists, CSV caches and JSON documents.

An absent path is an empty relation where optional is set, else the scan's own error.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolith import schema
from orolith.functions.urls import fix_scheme, stem


def _or_empty(spark: SparkSession, read, empty: T.StructType, optional: bool) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if optional and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], empty)
        raise


def read_lines(spark: SparkSession, path: str, optional: bool = False) -> DataFrame:
    """(ordinal, url): every line, blank ones too. Ordinals follow the lines of one file; those of several files come in the order in which Spark packs the files."""
    lines = lambda: spark.read.text(path).select(F.monotonically_increasing_id().alias("ordinal"), F.col("value").alias("url"))
    return _or_empty(spark, lines, schema.INVENTORY, optional)


def nonblank(lines: DataFrame) -> DataFrame:
    """Drops blank lines and leaves the others as they are."""
    return lines.where(F.trim("url") != "")


def trimmed(lines: DataFrame) -> DataFrame:
    """Non-blank lines, trimmed, with their scheme fixed."""
    return nonblank(lines).withColumn("url", fix_scheme(F.trim("url")))


def _csv(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """All columns as text, by header name; columns that the file lacks are null."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    return raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast("string").alias(f.name) for f in columns], F.monotonically_increasing_id().alias("ordinal"))


def as_bool(text: F.Column) -> F.Column:
    """Text true in any case; anything else is false."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))


def read_checks(spark: SparkSession, path: str, optional: bool = True) -> DataFrame:
    """The raster cache, also of the layout with three columns. Whole numbers may be written with a fraction."""
    whole = lambda c: F.col(c).try_cast("double").cast("int").alias(c)
    parse = lambda: _csv(spark, path, schema.CHECKS_CSV).select(
        "ordinal", "url", as_bool(F.col("is_geotiff")).alias("is_geotiff"), as_bool(F.col("is_cog")).alias("is_cog"), whole("epsg"), whole("height"), whole("width"),
        F.from_json("transform", schema.DOUBLES).alias("transform"), F.from_json("bounds", schema.DOUBLES).alias("bounds"))
    return _or_empty(spark, parse, schema.CHECKS, optional)


def read_access(spark: SparkSession, path: str, optional: bool = True) -> DataFrame:
    parse = lambda: _csv(spark, path, schema.ACCESS).select("url", F.col("status_code").try_cast("double").cast("int").alias("status_code"), as_bool(F.col("accessible")).alias("accessible"), F.coalesce("error", F.lit("")).alias("error"), "last_checked")
    return _or_empty(spark, parse, schema.ACCESS, optional)


def read_report(spark: SparkSession, path: str, optional: bool = True) -> DataFrame:
    """The validation report; a row of an id that comes again replaces the one before."""
    parse = lambda: _csv(spark, path, schema.REPORT).groupBy("item_id").agg(F.max_by(F.struct("item_path", "json_exists", "json_valid", "validation_error", "last_checked"), "ordinal").alias("r")).select("r.item_path", "item_id", as_bool(F.col("r.json_exists")).alias("json_exists"), as_bool(F.col("r.json_valid")).alias("json_valid"), F.nullif("r.validation_error", F.lit("")).alias("validation_error"), "r.last_checked")
    return _or_empty(spark, parse, schema.REPORT, optional)


def invalid_ids(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, item_id) of the report's rows that say false, each as it is there."""
    return _csv(spark, path, schema.REPORT).where(F.lower("json_valid") == "false").select("ordinal", "item_id")


DOCUMENT = T.StructType([T.StructField("item_path", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("body", T.StringType())])


def read_documents(spark: SparkSession, path: str, glob: str = "*.json", skip_collection: bool = True, optional: bool = False) -> DataFrame:
    """(item_path, item_id, body) of JSON files, a file a row. glob *-*.json takes only ids with a dash."""
    def scan() -> DataFrame:
        plain = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))  # Spark gives paths in the form of URLs
        files = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select(plain.alias("item_path"), F.col("value").alias("body")).select("item_path", stem(F.col("item_path")).alias("item_id"), "body")
        return files.where("item_id <> 'collection'") if skip_collection else files

    return _or_empty(spark, scan, DOCUMENT, optional)


def json_paths(spark: SparkSession, path: str) -> list[str]:
    """JSON files in a folder itself, none where it is absent."""
    return [r["item_path"] for r in read_documents(spark, path, skip_collection=False, optional=True).select("item_path").collect()]


def count_json(spark: SparkSession, path: str) -> int:
    """JSON files in a folder and those below, the collection's too; no content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path).select("path").count()


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.COLLECTION).json(path, multiLine=True)


def collection_items(collection: DataFrame, items: DataFrame) -> DataFrame:
    """Items that a collection's item links name, by their file's id, in link order."""
    links = collection.select(F.posexplode("links").alias("ordinal", "link")).where("link.rel = 'item'").select("ordinal", stem(F.col("link.href")).alias("_id"))
    return links.join(items, F.col("_id") == F.col("id")).drop("_id")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Object names below a folder as (url), names only: the offline form of an object-store listing."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif").load(path).select(F.col("path").alias("url"))
