"""PNG tiles with the standard library's zlib: encode, decode, packed pixels, tile trees."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map

SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encoded(pixels: np.ndarray, level: int = 6) -> bytes:
    """PNG of (height, width, 3 or 4) bytes; a fully opaque image is written without alpha."""
    if pixels.shape[2] == 4 and (pixels[..., 3] == 255).all():
        pixels = pixels[..., :3]
    height, width, bands = pixels.shape
    rows = np.concatenate([np.zeros((height, 1), np.uint8), np.ascontiguousarray(pixels).reshape(height, width * bands)], axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, 6 if bands == 4 else 2, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + _chunk(b"IEND", b"")


def decoded(data: bytes) -> np.ndarray:
    """8-bit RGB or RGBA pixels of a PNG without interlace; alpha is added where there is none."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, head = 8, b"", None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        head = struct.unpack(">IIBBBBB", part) if kind == b"IHDR" else head
        body += part if kind == b"IDAT" else b""
        at += 12 + size
    width, height, depth, colour, _, _, interlace = head
    bands = {2: 3, 6: 4, 0: 1}.get(colour)
    if depth != 8 or interlace or bands is None:
        raise ValueError("only 8-bit gray, RGB and RGBA without interlace")
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * bands)
    out = np.zeros((height, width * bands), np.int64)
    for y in range(height):
        line, up = raw[y, 1:].astype(np.int64), out[y - 1] if y else np.zeros(width * bands, np.int64)
        kind = raw[y, 0]
        if kind in (0, 2):
            out[y] = (line + (up if kind == 2 else 0)) & 255
            continue
        for x in range(width * bands):
            left = out[y, x - bands] if x >= bands else 0
            corner = up[x - bands] if x >= bands else 0
            if kind == 1:
                guess = left
            elif kind == 3:
                guess = (left + up[x]) // 2
            else:
                p = left + up[x] - corner
                guess = min((left, up[x], corner), key=lambda v: abs(p - v))
            out[y, x] = (line[x] + guess) & 255
    pixels = out.reshape(height, width, bands).astype(np.uint8)
    pixels = np.repeat(pixels, 3, axis=2) if bands == 1 else pixels
    return pixels if pixels.shape[2] == 4 else np.concatenate([pixels, np.full((height, width, 1), 255, np.uint8)], axis=2)


def pack_chips(pixels: DataFrame, size: int, extra: list[str] | None = None) -> DataFrame:
    """Gray pixels ``c, a`` with px, py to one packed RGBA value for each tile; every pixel is present."""
    keys = ["z", "x", "y", *(extra or [])]
    two = lambda v: F.lpad(F.hex(v), 2, "0")
    cell = F.struct("py", "px", F.concat(two(F.col("c")), two(F.col("c")), two(F.col("c")), two(F.col("a"))).alias("v"))
    # size * size pixels at most
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(cell)), lambda s: s["v"]), "")
    return pixels.groupBy(*keys).agg(F.unhex(joined).alias("rgba"))


def unpacked(tiles: DataFrame, size: int) -> DataFrame:
    """Packed tiles ``z, x, y, rgba`` to one row a pixel: ``z, x, y, px, py, r, g, b, a``."""
    each = tiles.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(size * size - 1))))
    band = lambda k: F.conv(F.hex(F.substring(F.col("rgba"), F.col("_at") * 4 + k + 1, F.lit(1))), 16, 10).cast("int")
    return each.select("z", "x", "y", (F.col("_at") % size).cast("int").alias("px"), F.floor(F.col("_at") / size).cast("int").alias("py"), *(band(k).alias(c) for k, c in enumerate("rgba")))


def encode(tiles: DataFrame, size: int) -> DataFrame:
    """Packed tiles ``z, x, y, rgba`` to ``z, x, y, nbytes, png``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = [encoded(np.frombuffer(v.as_py(), np.uint8).reshape(size, size, 4)) for v in batch.column("rgba")]
            yield pa.RecordBatch.from_arrays([batch.column("z"), batch.column("x"), batch.column("y"), pa.array([len(f) for f in files], pa.int64()), pa.array(files, pa.binary())], ["z", "x", "y", "nbytes", "png"])

    rows = tiles.select(F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "rgba")
    return arrow_map(rows, made, "z int, x long, y long, nbytes long, png binary")


def decode(files: DataFrame) -> DataFrame:
    """``z, x, y, png`` to ``z, x, y, rgba``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("z"), batch.column("x"), batch.column("y"), pa.array([decoded(v.as_py()).tobytes() for v in batch.column("png")], pa.binary())], ["z", "x", "y", "rgba"])

    return arrow_map(files.select(F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "png"), read, "z int, x long, y long, rgba binary")


def write_tree(tiles: DataFrame, folder: str) -> None:
    """Write ``z, x, y, png`` as ``folder/z/x/y.png``, each file complete or absent.

    The folder must be one that all executors share; a repeated task writes the same bytes again.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for z, x, y, data in zip(*(batch.column(c).to_pylist() for c in ("z", "x", "y", "png")), strict=True):
                where = os.path.join(folder, str(z), str(x))
                os.makedirs(where, exist_ok=True)
                part = os.path.join(where, f"{y}.{os.getpid()}.part")
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, os.path.join(where, f"{y}.png"))
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    arrow_map(tiles.select("z", "x", "y", "png"), put, "n long").agg(F.sum("n")).collect()


TREE = "z int, x long, y long, nbytes long, mtime timestamp, path string"


def read_tiles(tiles: DataFrame) -> DataFrame:
    """Scanned tiles to ``z, x, y, rgba``; workers open the files, in the folder that all of them share."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.slice(low, 64)
                files = [re.sub("^file:/*", "/", unquote(p)) for p in part.column("path").to_pylist()]
                rgba = []
                for name in files:
                    with open(name, "rb") as f:
                        rgba.append(decoded(f.read()).tobytes())
                yield pa.RecordBatch.from_arrays([part.column("z"), part.column("x"), part.column("y"), pa.array(rgba, pa.binary())], ["z", "x", "y", "rgba"])

    return arrow_map(tiles.select("z", "x", "y", "path"), read, "z int, x long, y long, rgba binary")


def tile_of_path(path: Column, suffix: str = "png") -> Column:
    """``z, x, y`` of a file in a tile tree; null for a name that isn't all numbers."""
    pattern = rf"/(\d+)/(\d+)/(\d+)\.{suffix}$"
    part = lambda i, kind: F.regexp_extract(path, pattern, i).cast(kind)
    return F.when(path.rlike(pattern), F.struct(part(1, "int").alias("z"), part(2, "long").alias("x"), part(3, "long").alias("y")))


def scan_tree(spark: SparkSession, folder: str, suffix: str = "png") -> DataFrame:
    """``z, x, y, nbytes, mtime, path`` of a tile tree; other names are left out, contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}").load(folder).select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("nbytes"))
    return files.withColumn("t", tile_of_path(F.col("path"), suffix)).where("t is not null").select("t.*", "nbytes", "mtime", "path")
