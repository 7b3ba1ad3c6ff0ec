"""Catalog relations projected from the driver's tables, in SQL that Spark and DuckDB share.

{t:name} stands for a table, {list:...} for an array of doubles; as_spark and as_duckdb
fill them in.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

INVENTORY = """
SELECT o_orderkey AS ordinal, concat(CASE WHEN o_orderkey % 10 = 9 THEN 'https://' ELSE 'https:/' END, 'objects.example.org/tiles/',
  CASE o_orderkey % 5
    WHEN 0 THEN concat(lpad(CAST(o_custkey % 100 AS STRING), 3, '0'), '/dem/bc_', CAST(o_orderkey AS STRING), '_xli1m_utm', CAST(8 + o_orderkey % 4 AS STRING), '_', d8, '.tif')
    WHEN 1 THEN concat(lpad(CAST(o_custkey % 100 AS STRING), 3, '0'), '/', d4, '/dem/bc_', CAST(o_orderkey AS STRING), '_xli1m_utm10_', d4, '.tif')
    WHEN 2 THEN concat(lpad(CAST(o_custkey % 100 AS STRING), 3, '0'), '/', d4, '/dem/bc_', CAST(o_orderkey AS STRING), '_xl1m_17603.tif')
    WHEN 3 THEN concat('albers10k2m/_completed_dem/dem_', CAST(o_orderkey AS STRING), '.tif')
    ELSE concat('new-area/dem/bc ', CAST(o_orderkey AS STRING), ' (2)_utm9_', substring(d8, 1, 6), '.tif') END) AS url
FROM (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING) AS d8, CAST(year(o_orderdate) AS STRING) AS d4 FROM {t:orders}) o
"""

FRESH = f"SELECT ordinal, url FROM ({INVENTORY}) i WHERE ordinal % 7 <> 3 UNION ALL SELECT ordinal + 1000000000 AS ordinal, url FROM ({INVENTORY}) i WHERE ordinal % 97 = 0 AND ordinal % 7 <> 3"
CACHED = f"SELECT ordinal, url FROM ({INVENTORY}) i WHERE ordinal % 11 <> 5"

_ONE_CHECK = f"""
SELECT ordinal, url, ordinal % 17 <> 0 AS is_geotiff, ordinal % 3 = 0 AS is_cog,
  CAST(CASE WHEN ordinal % 70 = 7 THEN 3157 WHEN ordinal % 70 = 21 THEN 2955 WHEN ordinal % 70 = 14 THEN 32609 WHEN ordinal % 70 = 28 THEN 3154 WHEN ordinal % 7 < 5 THEN 26907 + ordinal % 7 WHEN ordinal % 7 = 5 THEN 3005 END AS INT) AS epsg,
  CAST(CASE WHEN ordinal % 17 <> 0 THEN 2000 END AS INT) AS height, CAST(CASE WHEN ordinal % 17 <> 0 THEN 2500 END AS INT) AS width,
  CAST(300000 + (ordinal * 37 % CASE WHEN ordinal % 7 = 5 THEN 1500 ELSE 400 END) * 1000 AS DOUBLE) AS l,
  CAST(CASE WHEN ordinal % 7 = 5 THEN 400000 + (ordinal * 53 % 1300) * 1000 ELSE 5400000 + (ordinal * 53 % 1200) * 1000 END AS DOUBLE) AS b,
  CAST(10000 + (ordinal % 11) * 1000 AS DOUBLE) AS size
FROM ({INVENTORY}) i WHERE ordinal % 13 <> 0
"""
CHECKS = f"""
SELECT ordinal, url, is_geotiff, is_cog, epsg, height, width,
  CASE WHEN is_geotiff AND ordinal % 19 <> 0 THEN {{list:size / 2500e0, 0e0, l, 0e0, -size / 2000e0, b + size}} END AS transform,
  CASE WHEN is_geotiff THEN {{list:l, b, l + size, b + size}} END AS bounds FROM ({_ONE_CHECK}) c
UNION ALL
SELECT ordinal + 1000000000, url, is_geotiff, NOT is_cog, epsg, height, width,
  CASE WHEN is_geotiff THEN {{list:size / 2500e0, 0e0, l, 0e0, -size / 2000e0, b + size}} END,
  CASE WHEN is_geotiff THEN {{list:l, b, l + size, b + size}} END FROM ({_ONE_CHECK}) c WHERE ordinal % 23 = 0
"""

REPORT = """
SELECT concat('items/', item_id, '.json') AS item_path, item_id, n % 5 <> 0 AS json_exists, n % 5 <> 0 AND q % 7 <> 0 AS json_valid,
  CASE WHEN n % 5 = 0 THEN 'File not found' WHEN q % 7 = 0 THEN 'STAC validation error: bbox' END AS validation_error, '2026-01-01T00:00:00' AS last_checked
FROM (SELECT concat('tile-', CAST(l_orderkey AS STRING)) AS item_id, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM {t:lineitem} GROUP BY l_orderkey) r
"""
#: Ids of the inventory that have order lines count as reported.
BACKING = f"""
SELECT i.ordinal, i.url, r.n % 3 <> 0 AS json_valid FROM ({INVENTORY}) i JOIN (SELECT l_orderkey, count(*) AS n FROM {{t:lineitem}} GROUP BY l_orderkey) r ON i.ordinal = r.l_orderkey WHERE r.n > 1
"""

PROBES = """
SELECT concat('https://objects.example.org/tiles/', CAST(event_id AS STRING), '.tif') AS url,
  CAST(CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 403 END ELSE 200 END AS INT) AS status,
  CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Forbidden' WHEN event_type <> 'error' THEN 'OK' END AS reason,
  CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN 'timed out' END AS failure, event_id FROM {t:events}
"""

#: Small lon/lat boxes for search, without projection math.
ITEMS = """
SELECT concat('item-', CAST(o_orderkey AS STRING)) AS item_id, 'elevation' AS collection, o_orderkey % 6 = 0 AS datetime_unknown,
  CASE WHEN o_orderkey % 6 = 0 THEN '2000-01-01T00:00:00Z' ELSE concat(CAST(2015 + o_orderkey % 8 AS STRING), '-', lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0'), '-15T00:00:00Z') END AS datetime,
  -139e0 + (o_orderkey * 7919 % 2400) / 100e0 AS west, 48e0 + (o_orderkey * 104729 % 1150) / 100e0 AS south,
  -139e0 + (o_orderkey * 7919 % 2400) / 100e0 + 0.05e0 + (o_orderkey % 9) / 50e0 AS east, 48e0 + (o_orderkey * 104729 % 1150) / 100e0 + 0.05e0 + (o_orderkey % 7) / 50e0 AS north
FROM {t:orders}
"""
AREAS = """
SELECT n_nationkey AS area_id, n_name AS name, -138e0 + n_nationkey * 0.8e0 AS west, 49e0 + (n_nationkey * 3 % 8) AS south,
  -138e0 + n_nationkey * 0.8e0 + 2.5e0 AS east, 49e0 + (n_nationkey * 3 % 8) + 1.5e0 AS north FROM {t:nation}
"""

#: Quadrilaterals in the areas' boxes, their corners at the middle of the sides, a little inside.
DIAMONDS = f"""
SELECT area_id, (west + east) / 2 AS cx, (south + north) / 2 AS cy, 1.2345671e0 AS rx, 0.7345673e0 AS ry FROM ({AREAS}) a
"""

_TURNED = f"""
SELECT item_id, (west + east) / 2 AS cx, (south + north) / 2 AS cy, (east - west) * 3 AS hx, (north - south) * 3 AS hy,
  CASE WHEN datetime_unknown THEN 0.8e0 ELSE 0.28e0 END AS c, CASE WHEN datetime_unknown THEN 0.6e0 ELSE 0.96e0 END AS s FROM ({ITEMS}) i
"""
#: The corners of items' boxes, made larger and turned.
QUADS = f"""
SELECT item_id, cx + c * hx - s * hy AS x1, cy + s * hx + c * hy AS y1, cx - c * hx - s * hy AS x2, cy - s * hx + c * hy AS y2,
  cx - c * hx + s * hy AS x3, cy - s * hx - c * hy AS y3, cx + c * hx + s * hy AS x4, cy + s * hx - c * hy AS y4 FROM ({_TURNED}) t
"""

TREE = "https://catalog.example.org/t"
#: Child links in all forms that an address may have: of the root to regions, these to nations, these to customers, these to orders.
TREE_LINKS = f"""
SELECT '{TREE}/catalog.json' AS source, 'child' AS rel, concat('./r', CAST(r_regionkey AS STRING), '/catalog.json') AS href FROM {{t:region}}
UNION ALL SELECT concat('{TREE}/r', CAST(n_regionkey AS STRING), '/catalog.json'), 'child', concat('../n', CAST(n_nationkey AS STRING), '/x/../catalog.json') FROM {{t:nation}}
UNION ALL SELECT concat('{TREE}/n', CAST(c_nationkey AS STRING), '/catalog.json'), 'child', concat('/t/c', CAST(c_custkey AS STRING), '/catalog.json') FROM {{t:customer}}
UNION ALL SELECT concat('{TREE}/c', CAST(o_custkey AS STRING), '/catalog.json'), 'child', concat('{TREE}/o', CAST(o_orderkey AS STRING), '/catalog.json') FROM {{t:orders}}
"""

LOCAL = """
SELECT doc_id, concat(CAST(doc_id AS STRING), '.json') AS name, concat('d', CAST(doc_id AS STRING)) AS id, lang AS datetime, doc_id % 4 = 0 AS datetime_unknown, {list:n_chars / 1e0, doc_id / 1e0} AS geometry, {list:doc_id / 2e0} AS bbox, 1 AS asset_count FROM {t:documents}
"""
REMOTE = """
SELECT concat(CAST(doc_id AS STRING), '.json') AS name, concat('d', CAST(doc_id + CASE WHEN doc_id % 50 = 1 THEN 1 ELSE 0 END AS STRING)) AS id,
  CASE WHEN doc_id % 30 <> 2 THEN lang END AS datetime, CASE WHEN doc_id % 4 = 0 THEN true WHEN doc_id % 9 <> 0 THEN false END AS datetime_unknown,
  {list:n_chars / 1e0, (doc_id + CASE WHEN doc_id % 25 = 3 THEN 1 ELSE 0 END) / 1e0} AS geometry, {list:doc_id / 2e0} AS bbox, CASE WHEN doc_id % 40 = 7 THEN 2 ELSE 1 END AS asset_count
FROM {t:documents} WHERE doc_id % 20 <> 19
"""

_MARK = re.compile(r"\{(t|list):([^{}]*)\}")


def as_duckdb(sql: str) -> str:
    return _MARK.sub(lambda m: m[2] if m[1] == "t" else f"list_value({m[2]})", sql)


def as_spark(sql: str, sf_dir: str) -> str:
    return _MARK.sub(lambda m: f"parquet.`{sf_dir}/{m[2]}.parquet`" if m[1] == "t" else f"array({m[2]})", sql)


def relation(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(as_spark(sql, sf_dir))


def listing(prefix: str) -> Iterator[str]:
    """Names held in the text files of a folder, as a lister of an object store would give those below a prefix; an absent folder has none."""
    store, root = pa.fs.FileSystem.from_uri(prefix) if "://" in prefix else (pa.fs.LocalFileSystem(), re.sub("^file:/+", "/", prefix))
    for found in store.get_file_info(pa.fs.FileSelector(root, allow_not_found=True)):
        if found.is_file and not found.base_name.startswith((".", "_")):
            with store.open_input_stream(found.path) as file:
                for line in io.TextIOWrapper(file, "utf-8", newline="\n"):
                    yield line.rstrip("\n")
