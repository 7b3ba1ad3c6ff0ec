"""Validation of item documents and the report that increments build on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orolith import schema
from orolith.functions.urls import error_text, stem

RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def parsed(documents: DataFrame) -> DataFrame:
    """Adds item and broken: the document as a struct, and the text where it isn't JSON."""
    with_record = T.StructType([*schema.ITEM.fields, T.StructField("_broken", T.StringType())])
    rows = documents.withColumn("_item", F.from_json("body", with_record, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    plain = F.try_parse_json(F.col("body")).isNull()
    return rows.withColumn("broken", F.when(F.col("body").isNotNull() & plain, F.col("body"))).withColumn("item", F.col("_item")).drop("_item")


def _rules() -> dict[str, Column]:
    """What an item must hold, by the name of the rule; each is true, or false where it isn't met."""
    item = lambda c: F.col(f"item.{c}")
    prop = lambda c: F.col(f"item.properties.`{c}`")
    size_in = lambda c, *n: F.coalesce(c.isNull() | F.size(c).isin(*n), F.lit(True))
    ring_closed = lambda r: (F.size(r) >= 4) & (F.element_at(r, 1) == F.element_at(r, -1))
    links_to_collection = F.exists(item("links"), lambda x: F.coalesce(x["rel"] == "collection", F.lit(False)))
    yes = lambda c: F.coalesce(c, F.lit(False))
    return {
        "type": yes(item("type") == "Feature"), "stac_version": item("stac_version").isNotNull(), "id": yes(F.length(item("id")) > 0),
        "geometry": item("geometry").isNull() | yes((item("geometry.type") == "Polygon") & F.forall(item("geometry.coordinates"), ring_closed)),
        "bbox": item("geometry").isNull() | yes(F.size(item("bbox")).isin(4, 6)),
        "datetime": yes(prop("datetime").rlike(RFC3339)) | (prop("datetime").isNull() & prop("start_datetime").isNotNull() & prop("end_datetime").isNotNull()),
        "links": yes(item("links").isNotNull() & F.forall(item("links"), lambda x: x["rel"].isNotNull() & x["href"].isNotNull())),
        "assets": yes(item("assets").isNotNull() & F.forall(F.map_values(item("assets")), lambda a: a["href"].isNotNull())),
        "collection": ~yes(links_to_collection) | item("collection").isNotNull(),
        "proj:shape": size_in(prop("proj:shape"), 2), "proj:transform": size_in(prop("proj:transform"), 6, 9), "proj:bbox": size_in(prop("proj:bbox"), 4, 6),
    }


def report(documents: DataFrame, checked_at: str | None = None) -> DataFrame:
    """Report rows of (item_path, body); a null body is a missing file. The first rule that fails names the error."""
    rows = parsed(documents)
    failed = F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in _rules().items()])
    error = (
        F.when(F.col("body").isNull(), "File not found").when(F.col("broken").isNotNull(), error_text("JSON decode error", F.col("broken")))
        .when(F.col("item").isNull(), "Unexpected error: not an object").when(failed.isNotNull(), error_text("STAC validation error", failed))
    )
    at = F.lit(checked_at) if checked_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return rows.withColumn("validation_error", error).select("item_path", stem(F.col("item_path")).alias("item_id"), F.col("body").isNotNull().alias("json_exists"), F.col("validation_error").isNull().alias("json_valid"), "validation_error", at.alias("last_checked"))


def summary(rows: DataFrame) -> DataFrame:
    """One row: total, valid, invalid, percent valid with one decimal (0 without rows), exit_code (1 if any is invalid)."""
    counts = rows.agg(F.count("*").alias("total"), F.count_if("json_valid").alias("valid"), F.count_if(F.expr("NOT json_valid")).alias("invalid"))
    percent = F.when(F.col("total") > 0, F.round(F.col("valid") / F.col("total") * 100, 1)).otherwise(0.0)
    return counts.withColumns({"percent": percent, "exit_code": F.when(F.col("invalid") > 0, 1).otherwise(0)})


def not_reported(documents: DataFrame, history: DataFrame) -> DataFrame:
    """Documents whose id the report lacks; an id that is there stays out even where it was invalid."""
    return documents.join(history.select(F.col("item_id").alias("_id")), stem(F.col("item_path")) == F.col("_id"), "left_anti")


def merge_reports(history: DataFrame, new: DataFrame) -> DataFrame:
    """The report after an increment: history, then new rows."""
    return history.unionByName(new)


def incremental_status(history: DataFrame, new: DataFrame) -> DataFrame:
    """One row: checked, invalid, exit_code. With nothing new the run is a success, whatever history holds."""
    sides = history.select("json_valid", F.lit(0).alias("_new")).unionByName(new.select("json_valid", F.lit(1).alias("_new")))
    counts = sides.agg(F.count_if(F.expr("_new = 1")).alias("checked"), F.count_if(F.expr("NOT json_valid")).alias("invalid"))
    return counts.withColumn("exit_code", F.when((F.col("checked") > 0) & (F.col("invalid") > 0), 1).otherwise(0))
