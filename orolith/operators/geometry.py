"""Joins and searches of general geometries: points, lines and polygons with holes, each against each.

Two geometries share a point where a segment of one meets a segment of the other, or where one lies inside the
other as a whole; then any of its points does. Both are equi-joins:
segments meet in a cell of a grid that both go through, and a point is tried against those edges alone whose row its ray runs along,
of the areas whose box holds it. So an outline of a million points is a million rows, not
one value, and no pair of geometries is tried edge by edge.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orolith.functions import shapes

EDGE = ("ax", "ay", "bx", "by")


def shaped(rows: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """(id, row, area, paths) of each distinct id and geometry text; geometries that aren't understood go. row tells an id's geometries apart."""
    read = rows.select(F.col(key).alias("id"), F.col(geometry).alias("text")).distinct()
    return shapes.with_shape(read.withColumn("row", F.xxhash64("text")), "text").drop("text")


def _edges(rows: DataFrame) -> DataFrame:
    """(id, row, area, ax, ay, bx, by) of all segments, by explodes and scalar columns, which Spark compiles; a lone point is a segment from it to itself."""
    paths = rows.select("id", "row", "area", F.explode("paths").alias("path"))
    ends = paths.select("*", F.explode(F.sequence(F.lit(1), F.greatest(F.size("path") - 1, F.lit(1)))).alias("k"))
    a, b = F.element_at("path", F.col("k")), F.element_at("path", F.least(F.col("k") + 1, F.size("path")))
    return ends.select("id", "row", "area", a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by"))


def _cut(edges: DataFrame, cell: float) -> DataFrame:
    """Adds the grid cells (cx, cy) of shapes.segment_cells() in steps: the columns of cells, the part of the segment in each, the rows of that part."""
    at = lambda v: F.floor(v / cell)
    ax, ay, bx, by = (F.col(c) for c in EDGE)
    columns = edges.select("id", *EDGE, F.explode(F.sequence(at(F.least(ax, bx)), at(F.greatest(ax, bx)))).alias("cx"))
    slope = F.coalesce((by - ay) / F.nullif(bx - ax, F.lit(0.0)), F.lit(0.0))
    y1 = F.when(ax == bx, ay).otherwise(ay + slope * (F.greatest(F.least(ax, bx), F.col("cx") * cell) - ax))
    y2 = F.when(ax == bx, by).otherwise(ay + slope * (F.least(F.greatest(ax, bx), (F.col("cx") + 1) * cell) - ax))
    parts = columns.select("*", y1.alias("y1"), y2.alias("y2"))
    low = F.greatest(F.least("y1", "y2") - shapes.SLACK * cell, F.least(ay, by))
    high = F.least(F.greatest("y1", "y2") + shapes.SLACK * cell, F.greatest(ay, by))
    return parts.select("id", *EDGE, "cx", F.explode(F.sequence(at(F.least(low, high)), at(F.greatest(low, high)))).alias("cy"))


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _renamed(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"_{c}") for c in rows.columns])


def crossing_pairs(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """(id, _id) whose segments meet."""
    cut = lambda rows: _cut(_edges(rows), cell)
    other = _renamed(cut(right))
    meet = shapes.segments_meet(tuple(F.col(c) for c in EDGE), tuple(F.col(f"_{c}") for c in EDGE))
    return cut(left).join(other, (F.col("cx") == F.col("_cx")) & (F.col("cy") == F.col("_cy")) & meet).select("id", "_id").distinct()


def inside_pairs(left: DataFrame, right: DataFrame, cell: float) -> DataFrame:
    """(id, _id) where the first point of a path of left lies inside an area of right: its ray to the east crosses an odd number of edges."""
    floor = lambda v: F.floor(v / cell)
    points = left.select("id", F.posexplode("paths").alias("path", "p"), "row").select("id", "row", "path", F.col("p")[0][0].alias("px"), F.col("p")[0][1].alias("py"))
    points = points.withColumns({"cx": floor(F.col("px")).cast("int"), "cy": floor(F.col("py")).cast("int")})
    boxes = right.where("area").select("id", "row", F.explode(F.array(F.array(*shapes.outer_box(F.col("paths"))))).alias("box"))
    boxes = boxes.select("id", "row", *[F.get("box", F.lit(k)).alias(n) for k, n in enumerate(("w", "s", "e", "n"))])
    span = lambda low, high: F.explode(F.sequence(floor(F.col(low)).cast("int"), floor(F.col(high)).cast("int")))
    boxes = _renamed(boxes.withColumn("cx", span("w", "e")).withColumn("cy", span("s", "n")))
    near = points.join(boxes, (F.col("cx") == F.col("_cx")) & (F.col("cy") == F.col("_cy")) & F.col("px").between(F.col("_w"), F.col("_e")) & F.col("py").between(F.col("_s"), F.col("_n")))
    near = near.select("id", "row", "path", "px", "py", "cy", "_id", "_row")
    edges = _edges(right.where("area"))
    rows = F.explode(F.sequence(floor(F.least("ay", "by")).cast("int"), floor(F.greatest("ay", "by")).cast("int")))
    edges = edges.where("ay <> by").withColumn("at", rows).select(F.col("id").alias("of"), F.col("row").alias("of_row"), *EDGE, "at")
    crossed = near.join(edges, (F.col("_id") == F.col("of")) & (F.col("_row") == F.col("of_row")) & (F.col("cy") == F.col("at")) & shapes.crosses_ray(F.col("px"), F.col("py"), *(F.col(c) for c in EDGE)))
    odd = crossed.groupBy("id", "row", "path", "_id", "_row").agg(F.count("*").alias("n")).where("n % 2 = 1")
    return odd.select("id", "_id").distinct()


def geometry_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, cell: float = 1.0, folder: str | None = None) -> DataFrame:
    """Pairs (left_key, right_key) of geometries (GeoJSON texts in the column geometry) that share a point, edges and ends included.

    cell: degrees; about the size of usual geometries. folder: a new one that driver and executors share, where parsed geometries are written once; without one each of the four uses parses them. Rows that repeat an id count as one id with all their geometries; null keys, null
    geometries and types other than the six of shapes.TYPES meet nothing.
    """
    a, b = shaped(left.where(F.col(left_key).isNotNull()), left_key), shaped(right.where(F.col(right_key).isNotNull()), right_key)
    if folder is not None:
        a, b = _kept(a, f"{folder}/left"), _kept(b, f"{folder}/right")
    pairs = crossing_pairs(a, b, cell).unionByName(inside_pairs(a, b, cell))
    back = inside_pairs(b, a, cell).select(F.col("_id").alias("id"), F.col("id").alias("_id"))
    return pairs.unionByName(back).distinct().select(F.col("id").alias(left_key), F.col("_id").alias(right_key))


def meeting(items: DataFrame, geometry: dict, cell: float = 1.0, key: str = "item_id", folder: str | None = None) -> DataFrame:
    """Items whose geometry shares a point with a GeoJSON geometry."""
    asked = items.sparkSession.createDataFrame([("asked", json.dumps(geometry))], "_asked string, geometry string")
    found = geometry_join(items, asked, key, "_asked", cell, folder).select(F.col(key).alias("_found"))
    return items.join(found, F.col(key) == F.col("_found"), "left_semi")
