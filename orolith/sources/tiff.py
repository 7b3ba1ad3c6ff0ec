"""Raster headers from TIFF and BigTIFF bytes: directories are decoded in tasks, what they mean is column logic.

A task turns bytes into the header struct of HEADER, whatever the byte order. Size, code,
transform, box and the layout rules of cloud-optimized files are expressions over it.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: read(offset, length) gives at most that many bytes of a file.
Read = Callable[[int, int], bytes]

HEADER = """struct<big: boolean, directories: array<struct<at: bigint, subfile: bigint, width: bigint, height: bigint, tiled: boolean, first_block: bigint, last_block: bigint>>,
 geokeys: array<int>, scale: array<double>, tiepoint: array<double>, matrix: array<double>>"""
_DIRECTORY = pa.struct([("at", pa.int64()), ("subfile", pa.int64()), ("width", pa.int64()), ("height", pa.int64()), ("tiled", pa.bool_()), ("first_block", pa.int64()), ("last_block", pa.int64())])
_HEADER = pa.struct([("big", pa.bool_()), ("directories", pa.list_(_DIRECTORY)), ("geokeys", pa.list_(pa.int32())), ("scale", pa.list_(pa.float64())), ("tiepoint", pa.list_(pa.float64())), ("matrix", pa.list_(pa.float64()))])

# Field types of the format as struct codes, the tags that are read, and keys of the GeoKey directory.
FIELD_TYPES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
SUBFILE, WIDTH, HEIGHT, STRIP_OFFSETS, TILE_WIDTH, TILE_OFFSETS = 254, 256, 257, 273, 322, 324
PIXEL_SCALE, TIEPOINT, MATRIX, GEOKEYS = 33550, 33922, 34264, 34735
RASTER_TYPE, GEOGRAPHIC_CODE, PROJECTED_CODE, PIXEL_IS_POINT, USER_DEFINED = 1025, 2048, 3072, 2, 32767
#: A first directory later than this, and an untiled image larger than this, are no cloud-optimized layout.
LATEST_DIRECTORY, UNTILED_SIZE = 300, 512


#: Files whose headers a task holds as Python objects at a time.
SLICE = 256


def _exactly(read: Read, offset: int, length: int) -> bytes:
    data = read(offset, length)
    if len(data) != length:
        raise ValueError(f"{length} bytes at {offset} lie outside the file")
    return data


def decode(read: Read) -> dict:
    """The header of a file; ValueError for bytes that aren't a TIFF, are cut off, or whose directories go in a circle."""
    start = _exactly(read, 0, 8)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    version = struct.unpack(f"{order}H", start[2:4])[0] if order else None
    if version not in (42, 43):
        raise ValueError("not a TIFF")
    big = version == 43
    pointer, counter, entry = ("Q", "Q", 20) if big else ("I", "H", 12)
    number = lambda code, data: struct.unpack(order + code, data)[0]
    at = number("Q", _exactly(read, 8, 8)) if big else number("I", start[4:8])
    found, directories = [], []
    while at:
        if at in found:
            raise ValueError("directories in a circle")
        found.append(at)
        head = struct.calcsize(f"={counter}")
        n = number(counter, _exactly(read, at, head))
        table = _exactly(read, at + head, n * entry + struct.calcsize(f"={pointer}"))
        fields = {}
        for k in range(n):
            tag, kind, count = struct.unpack(f"{order}HH{pointer}", table[k * entry : k * entry + entry - (8 if big else 4)])
            if kind not in FIELD_TYPES or tag not in (SUBFILE, WIDTH, HEIGHT, STRIP_OFFSETS, TILE_WIDTH, TILE_OFFSETS, PIXEL_SCALE, TIEPOINT, MATRIX, GEOKEYS):
                continue
            size = count * struct.calcsize(f"={FIELD_TYPES[kind]}")
            inline = table[(k + 1) * entry - (8 if big else 4) : (k + 1) * entry]
            data = inline[:size] if size <= len(inline) else _exactly(read, number(pointer, inline), size)
            fields[tag] = struct.unpack(f"{order}{count}{FIELD_TYPES[kind]}", data)
        if not fields.get(WIDTH) or not fields.get(HEIGHT):
            raise ValueError("a directory without a size")
        blocks = [b for b in fields.get(TILE_OFFSETS) or fields.get(STRIP_OFFSETS) or () if b]  # 0: a block left out
        directories.append({"fields": fields, "at": at, "subfile": (fields.get(SUBFILE) or (0,))[0], "width": fields[WIDTH][0], "height": fields[HEIGHT][0], "tiled": TILE_WIDTH in fields, "first_block": min(blocks, default=None), "last_block": max(blocks, default=None)})
        at = number(pointer, table[n * entry :])
    if not directories:
        raise ValueError("no directory")
    geo = directories[0]["fields"]
    numbers = lambda tag: [float(v) for v in geo[tag]] if tag in geo else None
    return {
        "big": big, "directories": [{k: v for k, v in d.items() if k != "fields"} for d in directories], "geokeys": list(geo[GEOKEYS]) if GEOKEYS in geo else None,
        "scale": numbers(PIXEL_SCALE), "tiepoint": numbers(TIEPOINT), "matrix": numbers(MATRIX),
    }


def _header_or_none(read: Read) -> dict | None:
    try:
        return decode(read)
    except Exception:  # noqa: BLE001 - whatever goes wrong with a file makes it unreadable, not the job
        return None


def _mapped(rows: DataFrame, key: str, reads: Callable[[pa.RecordBatch], Iterator[Read]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, SLICE):
                b = whole.slice(low, SLICE)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_header_or_none(r) for r in reads(b)], _HEADER)], [key, "header"])

    return rows.mapInArrow(run, f"{key} string, header {HEADER}")


def file_headers(files: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """(key, header) of whole files in a column of bytes, as spark.read.format("binaryFile") gives them; null for bytes that aren't a TIFF.

    For rasters too large to be rows use remote_headers(), which reads the header alone.
    """

    def reads(batch: pa.RecordBatch) -> Iterator[Read]:
        for cell in batch.column(1):
            data = memoryview(cell.as_buffer()) if cell.is_valid else b""
            yield lambda offset, length, data=data: bytes(data[offset : offset + length])

    return _mapped(files.select(F.col(key).cast("string").alias(key), content), key, reads)


def remote_headers(urls: DataFrame, fetch: Callable[[str, int, int], bytes], ahead: int = 16384, partitions: int = 32, key: str = "url") -> DataFrame:
    """(key, header) of remote files by ranges of bytes: fetch(url, offset, length) gives a range, less at the file's end.

    ahead: bytes of a request at least. A cloud-optimized file's header mostly takes one request; others take one more for a directory elsewhere.
    """

    def reads(batch: pa.RecordBatch) -> Iterator[Read]:
        for url in batch.column(0).to_pylist():
            parts: dict[int, bytes] = {}

            def read(offset: int, length: int, url=url, parts=parts) -> bytes:
                for at, data in parts.items():
                    if at <= offset and offset + length <= at + len(data):
                        return data[offset - at : offset - at + length]
                parts[offset] = fetch(url, offset, max(length, ahead))
                return parts[offset][:length]

            yield read

    return _mapped(urls.select(F.col(key).cast("string").alias(key)).repartition(partitions), key, reads)


def _geokey(keys: Column, number: int) -> Column:
    """A key's value where the GeoKey directory holds it itself; null for absent, user-defined and other keys."""
    entries = F.transform(F.sequence(F.lit(1), F.greatest(F.size(keys) / 4 - 1, F.lit(1)).cast("int")), lambda k: F.slice(keys, k * 4 + 1, 4))
    own = F.filter(entries, lambda e: (F.get(e, F.lit(0)) == number) & (F.get(e, F.lit(1)) == 0))
    return F.nullif(F.get(F.get(own, F.lit(0)), F.lit(3)), F.lit(USER_DEFINED))


def is_cloud_optimized(header: Column) -> Column:
    """The layout rules: larger images are tiled; the first directory lies at the file's start, those of overviews follow in order of falling size; data come in the opposite order, full resolution last."""
    levels = F.filter(header["directories"], lambda d: d["subfile"].bitwiseAND(4) == 0)  # no masks
    main = F.get(levels, F.lit(0))
    tiled = F.forall(levels, lambda d: d["tiled"] | (F.greatest(d["width"], d["height"]) <= UNTILED_SIZE))
    data_after = lambda upper, lower: F.coalesce(upper["first_block"] > lower["last_block"], F.lit(True))  # noqa: E731 - levels without data have no order
    smaller = lambda upper, lower: (lower["width"] <= upper["width"]) & (lower["height"] <= upper["height"])
    ordered = F.forall(
        F.sequence(F.lit(1), F.greatest(F.size(levels) - 1, F.lit(1))),
        lambda k: F.coalesce((F.get(levels, k)["at"] > F.get(levels, k - 1)["at"]) & smaller(F.get(levels, k - 1), F.get(levels, k)) & data_after(F.get(levels, k - 1), F.get(levels, k)), F.lit(True)),
    )
    blocks_late = F.forall(levels, lambda d: F.coalesce(d["first_block"] > d["at"], F.lit(True)))
    return F.coalesce((main["at"] <= LATEST_DIRECTORY) & tiled & ordered & blocks_late, F.lit(False))


def describe(headers: DataFrame, key: str = "url") -> DataFrame:
    """Rows of the raster cache: (key, is_geotiff, is_cog, epsg, height, width, transform, bounds). A header that is null makes an unreadable raster, all else null.

    Where a pixel's value stands for a point its cell begins half a pixel earlier. A raster without a transform has that of its pixels. The code is the projected one, else the geographic one.
    """
    h = F.col("header")
    main = F.get(h["directories"], F.lit(0))
    term = lambda name, k: F.get(h[name], F.lit(k))
    scaled = F.array(term("scale", 0), F.lit(0.0), term("tiepoint", 3) - term("tiepoint", 0) * term("scale", 0), F.lit(0.0), -term("scale", 1), term("tiepoint", 4) + term("tiepoint", 1) * term("scale", 1))
    by_matrix = F.array(*[term("matrix", k) for k in (0, 1, 3, 4, 5, 7)])
    pixels = F.array(*[F.lit(v) for v in (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)])
    given = F.when(F.size(h["matrix"]) == 16, by_matrix).when((F.size(h["scale"]) >= 2) & (F.size(h["tiepoint"]) >= 6), scaled)
    rows = headers.select(key, "header", F.explode(F.array(F.coalesce(given, pixels))).alias("_t"), (given.isNotNull() & F.coalesce(_geokey(h["geokeys"], RASTER_TYPE) == PIXEL_IS_POINT, F.lit(False))).alias("_point"))
    half = F.when(F.col("_point"), F.lit(0.5)).otherwise(F.lit(0.0))
    t = [F.get("_t", F.lit(k)) for k in range(6)]
    shifted = F.array(t[0], t[1], t[2] - (t[0] + t[1]) * half, t[3], t[4], t[5] - (t[3] + t[4]) * half)
    rows = rows.withColumn("_s", F.explode(F.array(shifted)))
    s, w, n = [F.get("_s", F.lit(k)) for k in range(6)], main["width"], main["height"]
    xs, ys = [s[2] + s[0] * i + s[1] * j for i in (F.lit(0), w) for j in (F.lit(0), n)], [s[5] + s[3] * i + s[4] * j for i in (F.lit(0), w) for j in (F.lit(0), n)]
    turned = (s[1] != 0) | (s[3] != 0)
    box = F.when(turned, F.array(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))).otherwise(F.array(s[2], s[5] + s[4] * n, s[2] + s[0] * w, s[5]))
    sound = h.isNotNull()
    code = F.coalesce(_geokey(h["geokeys"], PROJECTED_CODE), _geokey(h["geokeys"], GEOGRAPHIC_CODE))
    return rows.select(key, sound.alias("is_geotiff"), (sound & is_cloud_optimized(h)).alias("is_cog"), code.alias("epsg"), n.cast("int").alias("height"), w.cast("int").alias("width"), F.when(sound, F.col("_s")).alias("transform"), F.when(sound, box).alias("bounds"))
