"""Schemas of the catalog's relations and its fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DOUBLES = T.ArrayType(DOUBLE)


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


INVENTORY = _fields(ordinal=LONG, url=STRING)
#: Raster checks as stored: numbers may carry a fraction of zero, arrays are JSON text.
CHECKS_CSV = _fields(url=STRING, is_geotiff=STRING, is_cog=STRING, epsg=STRING, height=STRING, width=STRING, transform=STRING, bounds=STRING)
CHECKS = _fields(ordinal=LONG, url=STRING, is_geotiff=BOOL, is_cog=BOOL, epsg=INT, height=INT, width=INT, transform=DOUBLES, bounds=DOUBLES)
ACCESS = _fields(url=STRING, status_code=INT, accessible=BOOL, error=STRING, last_checked=STRING)
REPORT = _fields(item_path=STRING, item_id=STRING, json_exists=BOOL, json_valid=BOOL, validation_error=STRING, last_checked=STRING)
LINK = _fields(rel=STRING, href=STRING, type=STRING)
POLYGON = _fields(type=STRING, coordinates=T.ArrayType(T.ArrayType(DOUBLES)))
PROPERTIES = T.StructType([
    T.StructField("datetime", STRING), T.StructField("datetime_unknown", BOOL), T.StructField("start_datetime", STRING), T.StructField("end_datetime", STRING),
    T.StructField("proj:epsg", INT), T.StructField("proj:geometry", POLYGON), T.StructField("proj:bbox", DOUBLES), T.StructField("proj:shape", T.ArrayType(INT)), T.StructField("proj:transform", DOUBLES),
])
ASSET = _fields(href=STRING, type=STRING, roles=T.ArrayType(STRING))
ITEM = _fields(
    type=STRING, stac_version=STRING, stac_extensions=T.ArrayType(STRING), id=STRING, geometry=POLYGON, bbox=DOUBLES, properties=PROPERTIES,
    links=T.ArrayType(LINK), collection=STRING, assets=T.MapType(STRING, ASSET),
)
COLLECTION = _fields(
    type=STRING, stac_version=STRING, id=STRING, title=STRING, description=STRING, license=STRING,
    extent=_fields(spatial=_fields(bbox=T.ArrayType(DOUBLES)), temporal=_fields(interval=T.ArrayType(T.ArrayType(STRING)))), links=T.ArrayType(LINK),
)

# What the documents and rules must hold.
STAC_VERSION = "1.1.0"
PROJECTION_EXTENSION = "https://stac-extensions.github.io/projection/v1.1.0/schema.json"
MEDIA_TYPE = "image/tiff; application=geotiff"
MEDIA_TYPE_COG = "image/tiff; application=geotiff; profile=cloud-optimized"
FIRST_YEAR, LAST_YEAR = 2000, 2050
UNKNOWN_DATE = "2000-01-01T00:00:00Z"
DEFAULT_EXTENT = [-140.0, 48.0, -114.0, 60.0]
SHRINK_GUARD = 0.9
QA_PERCENT, QA_MAX = 1.0, 100
TEST_COUNT = 10

#: Where rasters lie and catalogs are published unless a caller says otherwise.
SOURCE = "https://objects.example.org/tiles"
PUBLISHED = "https://catalog.example.org/elevation"
COLLECTION_ID = "elevation"

_SIZES = {"oneOf": [{"minItems": n, "maxItems": n} for n in (4, 6)]}
_POLYGON = {"type": "object", "required": ["coordinates"], "properties": {"type": {"const": "Polygon"}, "coordinates": {"type": "array", "items": {"type": "array", "minItems": 4}}}}
#: What an item must hold as a JSON Schema: the rules of operators/validate.py that a schema can state (a ring's end can't be compared with its begin).
ITEM_RULES = {
    "type": "object",
    "required": ["type", "stac_version", "id", "geometry", "properties", "links", "assets"],
    "properties": {
        "type": {"const": "Feature"}, "stac_version": {"type": "string"}, "id": {"type": "string", "minLength": 1},
        "geometry": {"oneOf": [{"type": "null"}, _POLYGON]},
        "bbox": {"type": "array", "items": {"type": "number"}, **_SIZES},
        "properties": {
            "type": "object", "required": ["datetime"],
            "properties": {"datetime": {"type": ["string", "null"], "format": "date-time"}, "proj:shape": {"minItems": 2, "maxItems": 2}, "proj:transform": {"oneOf": [{"minItems": n, "maxItems": n} for n in (6, 9)]}, "proj:bbox": _SIZES},
            "if": {"properties": {"datetime": {"type": "null"}}}, "then": {"required": ["start_datetime", "end_datetime"]},
        },
        "links": {"type": "array", "items": {"type": "object", "required": ["rel", "href"]}},
        "assets": {"type": "object", "additionalProperties": {"type": "object", "required": ["href"]}},
    },
    "if": {"properties": {"geometry": {"type": "object"}}}, "then": {"required": ["bbox"]},
    "allOf": [{"if": {"properties": {"links": {"contains": {"properties": {"rel": {"const": "collection"}}, "required": ["rel"]}}}}, "then": {"required": ["collection"]}}],
}
