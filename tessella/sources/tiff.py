"""TIFF rasters without other libraries: 8-bit pixels in strips or tiles, plain, deflated or LZW, with GeoTIFF tags."""

from __future__ import annotations

import os
import shutil
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map

#: Bytes of each field type, the tags that carry georeference.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 12: 8, 16: 8}
SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, GEO_DOUBLES, GEO_ASCII, NODATA = 33550, 33922, 34264, 34735, 34736, 34737, 42113
GEO_TAGS = (SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, GEO_DOUBLES, GEO_ASCII)
PROJECTED_KEY, GEOGRAPHIC_KEY = 3072, 2048


class GeoReferenceError(ValueError):
    pass


@dataclass
class Header:
    order: str
    first: int
    tags: dict[int, tuple[int, int, bytes]] = field(default_factory=dict)

    def values(self, tag: int) -> list:
        if tag not in self.tags:
            return []
        kind, count, raw = self.tags[tag]
        code = {1: "B", 2: "B", 3: "H", 4: "I", 12: "d", 16: "Q"}[kind]
        return list(struct.unpack(f"{self.order}{count}{code}", raw))

    def one(self, tag: int, default: int = 0) -> int:
        found = self.values(tag)
        return found[0] if found else default

    @property
    def width(self) -> int:
        return self.one(256)

    @property
    def height(self) -> int:
        return self.one(257)

    @property
    def bands(self) -> int:
        return self.one(277, 1)

    @property
    def geotransform(self) -> list[float] | None:
        """``(x0, dx, rx, y0, ry, dy)``; null without one."""
        if m := self.values(TRANSFORM):
            return [m[3], m[0], m[1], m[7], m[4], m[5]]
        scale, tie = self.values(SCALE), self.values(TIEPOINT)
        if len(scale) < 2 or len(tie) != 6:
            return None
        return [tie[3] - tie[0] * scale[0], scale[0], 0.0, tie[4] + tie[1] * scale[1], 0.0, -scale[1]]

    @property
    def epsg(self) -> int | None:
        keys = self.values(GEO_KEYS)
        found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
        return found.get(PROJECTED_KEY) or found.get(GEOGRAPHIC_KEY)

    @property
    def is_georeferenced(self) -> bool:
        """Control points, or a system with a map that is not the identity."""
        points = len(self.values(TIEPOINT)) > 6
        return points or (self.epsg is not None and self.geotransform not in (None, [0, 1, 0, 0, 0, 1]))


def header(data: bytes) -> Header:
    """The first directory's tags."""
    return _directory(lambda at, n: data[at : at + n])


def read_header(path: str) -> Header:
    """The first directory's tags of a file, of which nothing else is read."""
    with open(path, "rb") as f:

        def part(at: int, n: int) -> bytes:
            f.seek(at)
            return f.read(n)

        return _directory(part)


def _directory(part: Callable[[int, int], bytes]) -> Header:
    """The first directory by a function that gives ``n`` bytes from ``at`` on."""
    start = part(0, 8)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    if order is None or len(start) < 8 or struct.unpack(f"{order}H", start[2:4])[0] != 42:
        raise ValueError("not a TIFF")
    (at,) = struct.unpack(f"{order}I", start[4:8])
    found = Header(order, at)
    (n,) = struct.unpack(f"{order}H", part(at, 2))
    entries = part(at + 2, 12 * n)
    for i in range(n):
        entry = entries[12 * i : 12 * i + 12]
        tag, kind, count = struct.unpack(f"{order}HHI", entry[:8])
        size = SIZES.get(kind, 1) * count
        found.tags[tag] = (kind, count, entry[8 : 8 + size] if size <= 4 else part(struct.unpack(f"{order}I", entry[8:])[0], size))
    return found


def _unlzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bit first, 256 clears the table and 257 ends."""
    table: list[bytes] = []
    out: list[bytes] = []
    bits, held, width, last = 0, 0, 9, b""
    for byte in data:
        bits, held = (bits << 8 | byte) & 0xFFFFFF, held + 8
        if held < width:
            continue
        held -= width
        code = bits >> held & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table = [bytes([k]) for k in range(256)] + [b"", b""]
            width, last = 9, b""
            continue
        word = table[code] if code < len(table) else last + last[:1]
        out.append(word)
        if last:
            table.append(last + word[:1])
        last = word
        width = max(9, min(12, (len(table) + 1).bit_length()))
    return b"".join(out)


UNPACK = {1: bytes, 5: _unlzw, 8: zlib.decompress, 32946: zlib.decompress}


def chunks(data: bytes, h: Header) -> Iterator[tuple[int, int, np.ndarray]]:
    """The strips or tiles of an image, one at a time: top, left, pixels (height, width, bands) inside the image."""
    if any(b != 8 for b in h.values(258) or [1]) or h.one(284, 1) != 1 or h.one(259, 1) not in UNPACK:
        raise ValueError("only 8-bit interleaved pixels, plain, deflated or LZW")
    unpack, tiled = UNPACK[h.one(259, 1)], 322 in h.tags
    width, height = (h.one(322), h.one(323)) if tiled else (h.width, h.one(278, h.height))
    across = -(-h.width // width)
    starts, sizes = (324, 325) if tiled else (273, 279)
    for k, (at, n) in enumerate(zip(h.values(starts), h.values(sizes), strict=True)):
        top, left = k // across * height, k % across * width
        rows = height if tiled else min(height, h.height - top)
        part = np.frombuffer(unpack(data[at : at + n]), np.uint8)[: rows * width * h.bands].reshape(rows, width, h.bands)
        if h.one(317, 1) == 2:
            part = np.cumsum(part, axis=1, dtype=np.uint8)
        yield top, left, part[: h.height - top, : h.width - left]


def _coloured(part: np.ndarray, h: Header) -> np.ndarray:
    """RGBA: a palette is looked up, gray is repeated, alpha is added where there is none."""
    if h.bands <= 2:
        if h.one(262) == 3:
            palette = (np.array(h.values(320)).reshape(3, -1).T // 257).astype(np.uint8)
            rgb = palette[part[..., 0]]
        else:
            rgb = np.repeat(part[..., :1], 3, axis=2)
    else:
        rgb = part[..., :3]
    alpha = part[..., -1:] if h.bands in (2, 4) else np.full((*part.shape[:2], 1), 255, np.uint8)
    return np.concatenate([rgb, alpha], axis=2)


def pixels(data: bytes) -> np.ndarray:
    """All pixels as RGBA bytes."""
    h = header(data)
    return np.concatenate([np.zeros((0, h.width, 4), np.uint8), *bands(data, h, 1024)])


Window = tuple[int, int, int, int]


def size_of(h: Header, window: Window | None = None) -> tuple[int, int]:
    """Width and height of an image, or of what a window (x0, y0, x1, y1) leaves of it."""
    x0, y0, x1, y1 = window or (0, 0, h.width, h.height)
    if not (0 <= x0 < x1 <= h.width and 0 <= y0 < y1 <= h.height):
        raise ValueError(f"the window {window} is not inside {h.width} by {h.height} pixels")
    return x1 - x0, y1 - y0


def bands(data: bytes, h: Header, rows: int, window: Window | None = None) -> Iterator[np.ndarray]:
    """The image, or a window of it, from the top down in RGBA bands of ``rows`` rows; the last may have fewer.

    Strips and tiles are unpacked one at a time, and a band leaves once it is whole.
    """
    width, height = size_of(h, window)
    x0, y0 = window[:2] if window else (0, 0)
    open_: dict[int, np.ndarray] = {}
    done = 0
    for top, left, part in chunks(data, h):
        part = part[max(0, y0 - top) : max(0, y0 + height - top), max(0, x0 - left) : max(0, x0 + width - left)]
        if not part.size:
            continue
        top, left = max(top - y0, 0), max(left - x0, 0)
        for k in range(done, top // rows):  # chunks come from the top down
            yield open_.pop(k)
        done = max(done, top // rows)
        colour = _coloured(part, h)
        for k in range(top // rows, (top + part.shape[0] - 1) // rows + 1):
            band = open_.setdefault(k, np.zeros((min(rows, height - k * rows), width, 4), np.uint8))
            a, b = max(top, k * rows), min(top + part.shape[0], (k + 1) * rows)
            band[a - k * rows : b - k * rows, left : left + part.shape[1]] = colour[a - top : b - top]
    for k in sorted(open_):
        yield open_[k]


def _entries(tags: dict[int, tuple[int, int, bytes]], order: str, at: int) -> bytes:
    """A directory placed at offset ``at``, with its longer values behind it."""
    body, extra = struct.pack(f"{order}H", len(tags)), b""
    behind = at + 2 + 12 * len(tags) + 4
    for tag in sorted(tags):
        kind, count, raw = tags[tag]
        body += struct.pack(f"{order}HHI", tag, kind, count)
        if len(raw) <= 4:
            body += raw.ljust(4, b"\0")
        else:
            body += struct.pack(f"{order}I", behind + len(extra))
            extra += raw + b"\0" * (len(raw) % 2)
    return body + struct.pack(f"{order}I", 0) + extra


def written(image: np.ndarray, geotransform: list[float] | None = None, epsg: int | None = None, deflate: bool = True) -> bytes:
    """A TIFF of (height, width, bands) bytes, one strip, with its georeference."""
    height, width, bands = image.shape
    strip = np.ascontiguousarray(image, np.uint8).tobytes()
    strip = zlib.compress(strip) if deflate else strip
    short, long_ = (lambda *v: (3, len(v), struct.pack(f"<{len(v)}H", *v))), (lambda *v: (4, len(v), struct.pack(f"<{len(v)}I", *v)))
    tags = {256: long_(width), 257: long_(height), 258: short(*[8] * bands), 259: short(8 if deflate else 1), 262: short(2 if bands >= 3 else 1), 273: long_(8), 277: short(bands), 278: long_(height), 279: long_(len(strip)), 284: short(1)}
    if bands == 4:
        tags[338] = short(2)
    if geotransform is not None:
        g = geotransform
        matrix = [g[1], g[2], 0, g[0], g[4], g[5], 0, g[3], 0, 0, 0, 0, 0, 0, 0, 1]
        tags[TRANSFORM] = (12, 16, struct.pack("<16d", *matrix))
    if epsg is not None:
        key, model = (GEOGRAPHIC_KEY, 2) if epsg == 4326 else (PROJECTED_KEY, 1)
        tags[GEO_KEYS] = short(1, 1, 0, 2, 1024, 0, 1, model, key, 0, 1, epsg)
    at = 8 + len(strip) + len(strip) % 2
    return b"II" + struct.pack("<HI", 42, at) + strip + b"\0" * (len(strip) % 2) + _entries(tags, "<", at)


class TiledWriter:
    """A TIFF written tile by tile, as they come: deflated RGB tiles, the directory behind them.

    Nothing but the tiles' places is held.  ``close`` gives the file its name; until then it is a part.
    """

    def __init__(self, path: str, width: int, height: int, side: int, georeference: dict[int, tuple[int, int, bytes]] | None = None):
        self.path, self.width, self.height, self.side = path, width, height, side
        self.tags = georeference or {}
        self.across, self.down = -(-width // side), -(-height // side)
        self.places: dict[tuple[int, int], tuple[int, int]] = {}
        self.part = f"{path}.{os.getpid()}.part"
        self.file = open(self.part, "wb")
        self.file.write(b"II" + struct.pack("<HI", 42, 0))

    def put(self, row: int, column: int, rgb: np.ndarray) -> None:
        """A tile of up to ``side`` pixels square; the rest of it is zero."""
        whole = np.zeros((self.side, self.side, 3), np.uint8)
        whole[: rgb.shape[0], : rgb.shape[1]] = rgb[..., :3]
        packed = zlib.compress(whole.tobytes())
        self.places[row, column] = self.file.tell(), len(packed)
        self.file.write(packed + b"\0" * (len(packed) % 2))

    def close(self) -> None:
        missing = [(r, c) for r in range(self.down) for c in range(self.across) if (r, c) not in self.places]
        for r, c in missing:
            self.put(r, c, np.zeros((1, 1, 3), np.uint8))
        order = [self.places[r, c] for r in range(self.down) for c in range(self.across)]
        long_ = lambda *v: (4, len(v), struct.pack(f"<{len(v)}I", *v))
        short = lambda *v: (3, len(v), struct.pack(f"<{len(v)}H", *v))
        tags = {256: long_(self.width), 257: long_(self.height), 258: short(8, 8, 8), 259: short(8), 262: short(2), 277: short(3), 284: short(1), 322: long_(self.side), 323: long_(self.side), 324: long_(*(a for a, _ in order)), 325: long_(*(n for _, n in order))}
        at = self.file.tell()
        self.file.write(_entries(tags | self.tags, "<", at))
        self.file.seek(4)
        self.file.write(struct.pack("<I", at))
        self.file.close()
        os.replace(self.part, self.path)


def georeference_tags(h: Header, scale: int = 1, origin: tuple[int, int] = (0, 0)) -> dict[int, tuple[int, int, bytes]]:
    """The tags that carry a header's georeference, for pixels ``scale`` times smaller that begin at pixel ``origin``."""
    tags = {t: h.tags[t] for t in (GEO_KEYS, GEO_DOUBLES, GEO_ASCII) if t in h.tags}
    if h.order != "<":
        wide = {t: SIZES.get(k, 1) for t, (k, _, _) in tags.items()}
        tags = {t: (k, n, raw if wide[t] == 1 else np.frombuffer(raw, f"u{wide[t]}").byteswap().tobytes()) for t, (k, n, raw) in tags.items()}
    if g := h.geotransform:
        x, y = origin
        matrix = [g[1] / scale, g[2] / scale, 0, g[0] + g[1] * x + g[2] * y, g[4] / scale, g[5] / scale, 0, g[3] + g[4] * x + g[5] * y, 0, 0, 0, 0, 0, 0, 0, 1]
        tags[TRANSFORM] = (12, 16, struct.pack("<16d", *matrix))
    return tags


def copy_georeference(reference: str, image: str, output: str, *, overwrite: bool = False, strict_size: bool = True, copy_nodata: bool = False) -> str:
    """``image`` with the georeference of ``reference``: pixels byte for byte, a new directory behind them."""
    for path in (reference, image):
        if not os.path.isfile(path):
            raise FileNotFoundError(path)
    there = os.path.exists(output)
    if there and (os.path.samefile(output, reference) or os.path.samefile(output, image)):
        raise ValueError("an input can't be the output")
    if there and not overwrite:
        raise FileExistsError(output)
    source = read_header(reference)
    if not source.is_georeferenced:
        raise GeoReferenceError(f"no usable georeference: {reference}")
    try:
        target = read_header(image)
    except ValueError as e:
        raise GeoReferenceError(f"no TIFF: {image}") from e
    if strict_size and (source.width, source.height) != (target.width, target.height):
        raise ValueError(f"sizes differ: {source.width} by {source.height} and {target.width} by {target.height} pixels")
    tags = {t: v for t, v in target.tags.items() if t not in GEO_TAGS}
    for tag in (*GEO_TAGS, *([NODATA] if copy_nodata else [])):
        if tag in source.tags:
            kind, count, raw = source.tags[tag]
            width = SIZES.get(kind, 1)
            if source.order != target.order and width > 1:
                raw = np.frombuffer(raw, f"u{width}").byteswap().tobytes()
            tags[tag] = (kind, count, raw)
    os.makedirs(os.path.dirname(os.path.abspath(output)), exist_ok=True)
    part = f"{output}.part"
    shutil.copyfile(image, part)
    try:
        size = os.path.getsize(part)
        at = size + size % 2
        with open(part, "r+b") as f:
            f.seek(size)
            f.write(b"\0" * (size % 2) + _entries(tags, target.order, at))
            f.seek(4)
            f.write(struct.pack(f"{target.order}I", at))
        if not read_header(part).is_georeferenced:
            raise GeoReferenceError(f"no georeference in what was written: {output}")
        os.replace(part, output)
    finally:
        if os.path.exists(part):
            os.unlink(part)
    return output


def transfers(references: DataFrame, images: DataFrame, strict_size: bool = True) -> DataFrame:
    """``name, verdict`` of each image and the reference of its name, from tables of :func:`headers`.

    ``verdict`` is ok, no reference, no georeference, or sizes differ.
    """
    r = references.select("name", F.col("width").alias("_w"), F.col("height").alias("_h"), "georeferenced", F.lit(True).alias("_there"))
    met = images.select("name", "width", "height").join(r, "name", "left")
    differ = (F.col("width") != F.col("_w")) | (F.col("height") != F.col("_h"))
    verdict = F.when(F.col("_there").isNull(), "no reference").when(~F.col("georeferenced"), "no georeference").when(F.lit(strict_size) & differ, "sizes differ").otherwise("ok")
    return met.select("name", verdict.alias("verdict"))


def headers(spark: SparkSession, path: str) -> DataFrame:
    """``path, width, height, bands, gt, epsg, georeferenced`` of TIFF files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [header(v.as_py()) for v in batch.column("content")]
            columns = [batch.column("path"), *(pa.array([getattr(h, n) for h in found], pa.int32()) for n in ("width", "height", "bands")), pa.array([h.geotransform for h in found], pa.list_(pa.float64())), pa.array([h.epsg for h in found], pa.int32()), pa.array([h.is_georeferenced for h in found])]
            yield pa.RecordBatch.from_arrays(columns, ["path", "width", "height", "bands", "gt", "epsg", "georeferenced"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path).select("path", "content")
    return arrow_map(files, read, "path string, width int, height int, bands int, gt array<double>, epsg int, georeferenced boolean")


def write_blocks(blocks: DataFrame, plan: dict[int, tuple[str, int, int, dict]], side: int) -> DataFrame:
    """Write blocks ``ord, bx, by, rgba`` of ``side`` pixels to files; ``plan`` has path, size and georeference tags by ``ord``.

    A file's blocks come to one task in their order and are written as they come, so one block is
    held; the folder must be one that all executors share.  Gives ``ord, blocks``.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, now, n = None, None, 0
        for batch in batches:
            for order, bx, by, rgba in zip(*(batch.column(c) for c in ("ord", "bx", "by", "rgba")), strict=True):
                if order.as_py() != now:
                    if writer:
                        writer.close()
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([n], pa.int64())], ["ord", "blocks"])
                    now, n = order.as_py(), 0
                    path, width, height, tags = plan[now]
                    writer = TiledWriter(path, width, height, side, tags)
                writer.put(by.as_py(), bx.as_py(), np.frombuffer(rgba.as_py(), np.uint8).reshape(side, side, 4))
                n += 1
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([n], pa.int64())], ["ord", "blocks"])

    ordered = blocks.select("ord", "bx", "by", "rgba").repartition(max(1, len(plan)), "ord").sortWithinPartitions("ord", "by", "bx")
    return arrow_map(ordered, write, "ord long, blocks long")


def raster_blocks(files: DataFrame, block: int = 256, windows: dict[int, Window] | None = None) -> DataFrame:
    """Files (``ord, content``) to blocks ``ord, bx, by, rgba`` of ``block`` pixels, zero beyond the image.

    ``windows`` cuts files by ``ord`` to a window of pixels.  A task holds the packed file and the open
    rows of blocks only.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, content in zip(batch.column("ord").to_pylist(), batch.column("content").to_pylist(), strict=True):
                h = header(content)
                for by, band in enumerate(bands(content, h, block, (windows or {}).get(order))):
                    n = -(-band.shape[1] // block)
                    row = np.zeros((block, n * block, 4), np.uint8)
                    row[: band.shape[0], : band.shape[1]] = band
                    parts = [row[:, bx * block : (bx + 1) * block].tobytes() for bx in range(n)]
                    yield pa.RecordBatch.from_arrays([pa.array([order] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([by] * n, pa.int32()), pa.array(parts, pa.binary())], ["ord", "bx", "by", "rgba"])

    return arrow_map(files.select("ord", "content"), cut, "ord long, bx int, by int, rgba binary")


def sampled(files: DataFrame, every: int = 1) -> DataFrame:
    """Files (``sheet, content``) to pixels ``sheet, col, row, r, g, b, width, height``, of each ``every``-th row and column.

    Sampled, not averaged; col and row count the samples.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, content in enumerate(batch.column("content").to_pylist()):
                h = header(content)
                for top, left, part in chunks(content, h):
                    rows, cols = np.arange(-top % every, part.shape[0], every), np.arange(-left % every, part.shape[1], every)
                    if not len(rows) or not len(cols):
                        continue
                    rgb = _coloured(part[np.ix_(rows, cols)], h)
                    y, x = np.meshgrid((rows + top) // every, (cols + left) // every, indexing="ij")
                    inside = (y < max(1, h.height // every)) & (x < max(1, h.width // every))
                    n = int(inside.sum())
                    whole = lambda v, n=n: pa.array(np.full(n, v, np.int32))
                    name = batch.column("sheet").slice(i, 1).take(pa.array(np.zeros(n, np.int32)))
                    yield pa.RecordBatch.from_arrays([name, *(pa.array(v[inside].astype(np.int32)) for v in (x, y, rgb[..., 0], rgb[..., 1], rgb[..., 2])), whole(h.width // every), whole(h.height // every)], ["sheet", "col", "row", "r", "g", "b", "width", "height"])

    kind = files.schema["sheet"].dataType.simpleString()
    return arrow_map(files.select("sheet", "content"), read, f"sheet {kind}, col int, row int, r int, g int, b int, width int, height int")
