"""Building tilesets from georeferenced TIFFs: prepare, plan, warp, composite, average, describe.

Pixels move twice: blocks of a sheet meet the tiles they reach, by an equality of block keys, and
the warped layers of a tile meet each other.  Levels below are averaged from tiles, each level
written to the shared folder before the next.
"""

from __future__ import annotations

import json
import logging
import math
import os
import shutil
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.geo import LambertConformalConic
from tessella.functions.grid import EPS, GEOGRAPHIC, HALF_WORLD, LATTICE_ERROR, MAX_LATITUDE, MERCATOR, RADIUS, TILE_SIZE, Scheme
from tessella.functions.workers import arrow_map, ship
from tessella.operators import bounds, composite, overview, resample, tileset
from tessella.plans import tiles as planning
from tessella.sources import png, tiff
from tessella.sources.folders import cut

EDGE_SEGMENTS, MARGIN, RASTER_BLOCK = 64, 12, 256
SCHEMES = {s.name: s for s in (MERCATOR, GEOGRAPHIC)}
#: Sheets whose paths are broadcast to their files.
MOST_SHEETS = 10_000
LOG = logging.getLogger("tessella")


class TileBuildError(RuntimeError):
    pass


@dataclass(frozen=True)
class Polygon:
    """Three points or more, in pixels or in degrees."""

    frame: str
    points: tuple[tuple[float, float], ...]

    def __post_init__(self) -> None:
        if self.frame not in ("pixel", "lonlat") or len(self.points) < 3:
            raise ValueError("a polygon has frame pixel or lonlat and three points or more")


@dataclass(frozen=True)
class MapArea:
    """Limits in degrees (west, south, east, north; null is open), polygons to include and to exclude."""

    limits: tuple[float | None, float | None, float | None, float | None] = (None, None, None, None)
    include: tuple[Polygon, ...] = ()
    exclude: tuple[Polygon, ...] = ()

    def __post_init__(self) -> None:
        w, s, e, n = self.limits
        if (w is not None and e is not None and e <= w) or (s is not None and n is not None and n <= s):
            raise ValueError("limits are empty")

    @property
    def is_whole_image(self) -> bool:
        return not self.include and not self.exclude and all(v is None for v in self.limits)


@dataclass(frozen=True)
class MosaicSource:
    path: str
    area: MapArea = field(default_factory=MapArea)
    detail: bool = False
    crs: LambertConformalConic | None = None


def _lcc_inverse(p: LambertConformalConic, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, f, rho_0 = p.constants()
    dx, dy = x - p.false_easting, rho_0 - (y - p.false_northing)
    rho = np.sign(n) * np.hypot(dx, dy)
    t = (rho / (p.semi_major * f)) ** (1 / n)
    lat = np.pi / 2 - 2 * np.arctan(t)
    for _ in range(8):
        es = p.eccentricity * np.sin(lat)
        lat = np.pi / 2 - 2 * np.arctan(t * ((1 - es) / (1 + es)) ** (p.eccentricity / 2))
    return np.degrees(np.arctan2(np.sign(n) * dx, np.sign(n) * dy) / n) + p.lon_0, np.degrees(lat)


def _lcc_forward(p: LambertConformalConic, lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, f, rho_0 = p.constants()
    phi, e = np.radians(lat), p.eccentricity
    t = np.tan(np.pi / 4 - phi / 2) / ((1 - e * np.sin(phi)) / (1 + e * np.sin(phi))) ** (e / 2)
    rho = p.semi_major * f * t**n
    theta = n * np.radians((lon - p.lon_0 + 180) % 360 - 180)
    return p.false_easting + rho * np.sin(theta), p.false_northing + rho_0 - rho * np.cos(theta)


@dataclass(frozen=True)
class Prepared:
    """A sheet as workers need it."""

    name: str
    width: int
    height: int
    gt: tuple[float, ...]
    crs: LambertConformalConic | int
    area: MapArea
    detail: bool
    centre: float

    def to_lonlat(self, col: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        g = self.gt
        x, y = g[0] + g[1] * col + g[2] * row, g[3] + g[4] * col + g[5] * row
        if self.crs == 3857:
            lon, lat = x * 180 / HALF_WORLD, np.degrees(2 * np.arctan(np.exp(y / RADIUS)) - np.pi / 2)
        elif self.crs == 4326:
            lon, lat = x, y
        else:
            lon, lat = _lcc_inverse(self.crs, x, y)
        return self.centre + (lon - self.centre + 180) % 360 - 180 if not math.isnan(self.centre) else lon, lat

    def from_grid(self, scheme: str, mx: np.ndarray, my: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source pixel coordinates of points in a scheme's units."""
        if scheme == MERCATOR.name:
            lon, lat = mx * 180 / HALF_WORLD, np.degrees(2 * np.arctan(np.exp(my / RADIUS)) - np.pi / 2)
        else:
            lon, lat = mx, my
        if self.crs == 3857:
            x, y = lon * HALF_WORLD / 180, RADIUS * np.log(np.tan(np.pi / 4 + np.radians(np.clip(lat, -MAX_LATITUDE, MAX_LATITUDE)) / 2))
        elif self.crs == 4326:
            x, y = lon, lat
        else:
            x, y = _lcc_forward(self.crs, lon, lat)
        g = self.gt
        det = g[1] * g[5] - g[2] * g[4]
        dx, dy = x - g[0], y - g[3]
        return (g[5] * dx - g[2] * dy) / det, (g[1] * dy - g[4] * dx) / det

    def mask(self, col: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Whether pixel centres belong to the map area."""
        lon, lat = self.to_lonlat(col, row)
        a = self.area
        inside = (col >= 0) & (col <= self.width) & (row >= 0) & (row <= self.height)
        for limit, ok in zip(a.limits, (lon.__ge__, lat.__ge__, lon.__le__, lat.__le__), strict=True):
            inside &= ok(limit) if limit is not None else True
        of = lambda p: _in_ring(p.points, col, row) if p.frame == "pixel" else _in_ring(p.points, lon, lat)
        if a.include:
            inside &= np.logical_or.reduce([of(p) for p in a.include])
        for p in a.exclude:
            inside &= ~of(p)
        return inside


def _in_ring(points, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    odd = np.zeros(x.shape, bool)
    for (x0, y0), (x1, y1) in zip(points, (*points[1:], points[0]), strict=True):
        if y0 != y1:
            odd ^= ((y0 > y) != (y1 > y)) & (x < x0 + (y - y0) * (x1 - x0) / (y1 - y0))
    return odd


def _header(source: MosaicSource) -> tiff.Header:
    h = tiff.read_header(source.path)
    if h.geotransform is None or (source.crs is None and h.epsg not in (3857, 4326)):
        raise TileBuildError(f"no coordinate system: {source.path}")
    return h


def _prepare(source: MosaicSource, scheme: Scheme = MERCATOR) -> tuple[Prepared, dict] | None:
    """A sheet and its footprint, from the file's first directory only; None where no map area is left."""
    h = _header(source)
    plain = Prepared(os.path.basename(source.path), h.width, h.height, tuple(h.geotransform), source.crs or h.epsg, source.area, source.detail, math.nan)
    centre = float(plain.to_lonlat(np.array(h.width / 2), np.array(h.height / 2))[0])
    sheet = Prepared(**{**plain.__dict__, "centre": centre})
    t = np.arange(EDGE_SEGMENTS) / EDGE_SEGMENTS
    left, top, right, bottom = _reach(source.area, h.width, h.height)
    if left >= right or top >= bottom:
        return None
    col = left + np.concatenate([t, np.ones_like(t), 1 - t, np.zeros_like(t)]) * (right - left)
    row = top + np.concatenate([np.zeros_like(t), t, np.ones_like(t), 1 - t]) * (bottom - top)
    lon, lat = sheet.to_lonlat(col, row)
    w, s, e, n = source.area.limits
    lon, lat = np.clip(lon, w, e) if (w, e) != (None, None) else lon, np.clip(lat, s, n) if (s, n) != (None, None) else lat
    if lon.min() >= lon.max() or lat.min() >= lat.max():
        return None
    held = np.clip(lat, -MAX_LATITUDE, MAX_LATITUDE)
    if scheme is MERCATOR:
        x, y = lon * HALF_WORLD / 180, RADIUS * np.log(np.tan(np.pi / 4 + np.radians(held) / 2))
    else:
        x, y = lon, lat
    near = 0.0 if lat.min() <= 0 <= lat.max() else float(np.abs(lat).min())
    metres = 111319.49079327357 if sheet.crs == 4326 else 1.0 / math.cos(math.radians(near)) if sheet.crs != 3857 else 1.0
    resolution = math.hypot(h.geotransform[1], h.geotransform[4]) * metres
    finest = 2 * HALF_WORLD / TILE_SIZE if scheme is MERCATOR else HALF_WORLD / TILE_SIZE
    zoom = max(0, math.ceil(math.log2(finest / resolution) - EPS))
    ring = list(zip(x.tolist(), y.tolist(), strict=True))
    return sheet, {"ring": ring, "lon_lo": float(lon.min()), "lon_hi": float(lon.max()), "lat_lo": float(lat.min()), "lat_hi": float(lat.max()), "zoom": zoom}


def _reach(area: MapArea, width: int, height: int) -> tuple[float, float, float, float]:
    """The box of the image that pixel polygons leave; polygons in degrees are left to the mask."""
    left, top, right, bottom = 0.0, 0.0, float(width), float(height)
    if area.include and all(p.frame == "pixel" for p in area.include):
        xs, ys = zip(*(q for p in area.include for q in p.points), strict=True)
        left, top, right, bottom = max(left, min(xs)), max(top, min(ys)), min(right, max(xs)), min(bottom, max(ys))
    return left, top, right, bottom


def lattice_of(tolerance: float) -> int:
    """Pixels between the places where the projection is worked out: 1 if it is to be exact."""
    return 1 if tolerance <= 0 else 2 ** int(math.log2(max(1.0, min(TILE_SIZE / 4, 16 * math.sqrt(tolerance / LATTICE_ERROR)))))


def _grid(scheme: Scheme, z: int, x: np.ndarray, y: np.ndarray, wrap: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``at`` pixels into tiles, in the scheme's units: arrays (tiles, rows, columns)."""
    columns, rows = scheme.base_columns << z, scheme.base_rows << z
    across, down = (scheme.east - scheme.west) / columns, (scheme.north - scheme.south) / rows
    mx = scheme.west + (x + wrap * columns)[:, None] * across + at * across / TILE_SIZE
    my = scheme.north - y[:, None] * down - at * down / TILE_SIZE
    shape = (len(x), len(at), len(at))
    return np.broadcast_to(mx[:, None, :], shape), np.broadcast_to(my[:, :, None], shape)


def _coordinates(sheet: Prepared, scheme: Scheme, z: int, x: int, y: int, wrap: int, lattice: int) -> tuple[np.ndarray, np.ndarray]:
    """Source coordinates of a tile's pixel centres; on a lattice they are interpolated between its nodes."""
    one = lambda v: np.array([v])
    centres = np.arange(TILE_SIZE) + 0.5
    nodes = centres if lattice == 1 else np.arange(0, TILE_SIZE + lattice, lattice, dtype=float)
    found = [v[0] for v in sheet.from_grid(scheme.name, *_grid(scheme, z, one(x), one(y), one(wrap), nodes))]
    if lattice == 1:
        return found[0], found[1]
    k = np.minimum((centres // lattice).astype(int), len(nodes) - 2)
    f = centres / lattice - k
    lines = [v[k] * (1 - f)[:, None] + v[k + 1] * f[:, None] for v in found]
    return tuple(v[:, k] * (1 - f) + v[:, k + 1] * f for v in lines)


def render(spark: SparkSession, sheets: list[Prepared], blocks: DataFrame, plan: DataFrame, kernel: str, scheme: Scheme = MERCATOR, tolerance: float = 0.0, skip_blank: bool = True) -> DataFrame:
    """Composited tiles ``z, x, y, nbytes, rgba`` of a plan."""
    lattice = lattice_of(tolerance)

    def windows(batches):
        """The blocks of its sheet that each planned tile reads, a whole batch of tiles of a sheet at a time."""
        names = ("ord", "z", "x", "y", "wrap")
        for batch in batches:
            table = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
            found = []
            for order, z in np.unique(table[:, :2], axis=0):
                rows = table[(table[:, 0] == order) & (table[:, 1] == z)]
                sheet = sheets[order]
                c, r = sheet.from_grid(scheme.name, *_grid(scheme, int(z), rows[:, 2], rows[:, 3], rows[:, 4], np.arange(0, TILE_SIZE + 16, 16.0)))
                step = lambda v, axis: np.abs(np.diff(v, axis=axis)).max(axis=(1, 2)) / 16
                reach = MARGIN * np.maximum(1.0, np.maximum(step(c, 2), step(r, 1)))
                low = lambda v, reach=reach: np.maximum(0, v.min(axis=(1, 2)) - reach)
                high = lambda v, size, reach=reach: np.minimum(size, v.max(axis=(1, 2)) + reach)
                c0, c1, r0, r1 = low(c), high(c, sheet.width), low(r), high(r, sheet.height)
                met = (c0 < c1) & (r0 < r1)
                rows, bounds = rows[met], [np.floor(v[met] / RASTER_BLOCK).astype(int) for v in (c0, np.ceil(c1), r0, np.ceil(r1))]
                wide, high_ = bounds[1] - bounds[0] + 1, bounds[3] - bounds[2] + 1
                at = np.repeat(np.arange(len(rows)), wide * high_)
                k = np.arange(len(at)) - np.repeat(np.cumsum(wide * high_) - wide * high_, wide * high_)
                found.append(np.concatenate([rows[at], (bounds[0][at] + k % wide[at])[:, None], (bounds[2][at] + k // wide[at])[:, None]], axis=1))
            out = np.concatenate(found) if found else np.empty((0, 7), np.int64)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(out[:, k]).cast(t) for k, t in enumerate(types)], [*names, "bx", "by"])

    def warped(table: pa.Table) -> pa.Table:
        order, z, x, y, wrap = (table.column(c)[0].as_py() for c in ("ord", "z", "x", "y", "wrap"))
        sheet, b = sheets[order], RASTER_BLOCK
        xs, ys = table.column("bx").to_pylist(), table.column("by").to_pylist()
        left, top = min(xs), min(ys)
        image = np.zeros(((max(ys) - top + 1) * b, (max(xs) - left + 1) * b, 4), np.uint8)
        for bx, by, rgba in zip(xs, ys, table.column("rgba").to_pylist(), strict=True):
            image[(by - top) * b : (by - top + 1) * b, (bx - left) * b : (bx - left + 1) * b] = np.frombuffer(rgba, np.uint8).reshape(b, b, 4)
        if not sheet.area.is_whole_image:
            col, row = np.meshgrid(np.arange(image.shape[1]) + left * b + 0.5, np.arange(image.shape[0]) + top * b + 0.5)
            image[~sheet.mask(col, row)] = 0
        c, r = _coordinates(sheet, scheme, z, x, y, wrap, lattice)
        layer = resample.warp(image, c - left * b, r - top * b, kernel)
        alpha = np.clip(layer[..., 3:], 0, 1)
        colour = np.where(alpha > 0, np.rint(np.clip(layer[..., :3] / np.where(alpha > 0, alpha, 1), 0, 255)), 0)
        rgba = np.concatenate([colour, np.rint(alpha * 255)], axis=2).astype(np.uint8).tobytes()
        return pa.table([pa.array([z], pa.int32()), pa.array([x], pa.int64()), pa.array([y], pa.int64()), pa.array([order * 4 + wrap + 1], pa.int64()), pa.array([rgba], pa.binary())], names=["z", "x", "y", "ord", "rgba"])

    ship(spark)
    wanted = arrow_map(plan.select(F.col("ord").cast("long").alias("ord"), "z", "x", "y", "wrap"), windows, "ord long, z int, x long, y long, wrap long, bx int, by int")
    layers = wanted.join(blocks, ["ord", "bx", "by"]).groupBy("z", "x", "y", "ord", "wrap").applyInArrow(warped, "z int, x long, y long, ord long, rgba binary")
    return composite.composite_packed(layers, TILE_SIZE, skip_blank)


def build_mosaic(spark: SparkSession, sources: list[MosaicSource], out: str, *, scheme: str = "mercator", min_zoom: int = 0, max_zoom: int | None = None, detail_zoom: int | None = None, resampling: str = "cubic", tolerance: float = 0.0, skip_blank: bool = True, resume: bool = False, overwrite: bool = False, title: str | None = None) -> dict:
    """Mosaic ``sources``, later ones on top, into ``out/tiles/z/x/y.png`` and ``out/metadata.json``.

    ``out`` is a folder that all executors share.  ``detail_zoom`` adds one sparse level of the
    tiles that detail sheets reach; levels below come from ``max_zoom``.  ``tolerance`` is how far, in
    source pixels, a coordinate may lie off the exact one.  With ``resume`` tiles that exist aren't
    made again: overviews read their children from the tree, whoever wrote them.  Sources without any
    map area are left out with a warning.  Gives the metadata.
    """
    if os.path.isdir(out) and os.listdir(out) and not (overwrite or resume):
        raise FileExistsError(f"{out} is not empty")
    if scheme not in SCHEMES:
        raise ValueError(f"no scheme {scheme}; there are {', '.join(sorted(SCHEMES))}")
    if overwrite and not resume and os.path.isdir(out):
        shutil.rmtree(out)
    grid, kernel = SCHEMES[scheme], resample.kernel_of(resampling)
    if not sources:
        raise TileBuildError("no sources")
    found = [(s, _prepare(s, grid)) for s in sources]
    for s in [s for s, p in found if p is None]:
        LOG.warning("no map area is left of %s; it is left out", s.path)
    sources, prepared = [s for s, p in found if p is not None], [p for _, p in found if p is not None]
    if not prepared:
        raise TileBuildError("no source has any map area")
    sheets = [p[0] for p in prepared]
    native = max(p[1]["zoom"] for p in prepared)
    top = native if max_zoom is None else max_zoom
    if min_zoom > top:
        raise ValueError(f"zooms run from {min_zoom} to {top}, which is none")
    if detail_zoom is not None and detail_zoom <= top:
        raise ValueError(f"the detail level, {detail_zoom}, has to be finer than the last full one, {top}")
    if detail_zoom is not None and not any(s.detail for s in sheets):
        raise ValueError("detail_zoom without a detail source")
    rows = [(i, s.detail, p["ring"], p["lon_lo"], p["lon_hi"], p["lat_lo"], p["lat_hi"]) for i, (s, p) in enumerate(prepared)]
    frame = spark.createDataFrame(rows, "ord long, detail boolean, ring array<struct<x:double,y:double>>, lon_lo double, lon_hi double, lat_lo double, lat_hi double")

    tree = os.path.join(out, "tiles")
    os.makedirs(tree, exist_ok=True)

    def written(z: int | None = None) -> DataFrame:
        folder = tree if z is None else os.path.join(tree, str(z))
        os.makedirs(folder, exist_ok=True)
        return png.scan_tree(spark, folder) if any(os.scandir(folder)) else spark.createDataFrame([], png.TREE)

    def put(level: DataFrame) -> None:
        png.write_tree(png.encode(level, TILE_SIZE), tree)

    def rendered(plan: DataFrame) -> DataFrame:
        return render(spark, sheets, blocks, plan, kernel, grid, tolerance, skip_blank)

    plans = [(top, planning.plan_tiles(frame, grid, top))]
    if detail_zoom is not None:
        plans.insert(0, (detail_zoom, planning.plan_detail(planning.plan_tiles(frame, grid, detail_zoom))))
        if not plans[0][1].take(1):
            raise ValueError(f"no detail source reaches a tile at zoom {detail_zoom}")
    todo = [(z, cut(planning.resume(plan, written(z)) if resume else plan, "plan")) for z, plan in plans]
    wanted = {r[0] for _, plan in todo for r in plan.select("ord").distinct().collect()}  # at most a row per sheet
    blocks = cut(_blocks(spark, [(i, s.path) for i, s in enumerate(sources) if i in wanted]), "blocks")
    for _, plan in todo:
        put(rendered(plan))
    for z in range(top, min_zoom, -1):
        children = written(z)
        lacking = overview.parents(children)
        lacking = planning.resume(lacking, written(z - 1)) if resume else lacking
        put(overview.halve_packed(png.read_tiles(overview.children_of(children, lacking)), TILE_SIZE))
    tiles = written()
    by_zoom = cut(tileset.per_zoom(tiles), "zooms")
    if not by_zoom.take(1):
        raise TileBuildError("no tiles were made")
    covered = tileset.covered(tiles, by_zoom, detail_zoom) if grid is MERCATOR else tileset.covered_geographic(tiles, by_zoom, detail_zoom)
    row = tileset.metadata(tileset.totals(by_zoom, detail_zoom), covered, bounds.data_bounds(frame.withColumn("g", F.lit(0)), ["g"]), name=title or os.path.basename(os.path.abspath(out)), source=", ".join(s.name for s in sheets), tile_format="png", scheme=grid.name, crs=grid.crs, native_zoom=native, sources=[s.name for s in sheets])
    found = json.loads(row.first()[0])
    found["url_template"] = "tiles/" + found["url_template"]
    with open(os.path.join(out, "metadata.json"), "w", encoding="utf-8") as f:
        json.dump(found, f, indent=2)
    return found


def _blocks(spark: SparkSession, paths: list[tuple[int, str]]) -> DataFrame:
    """Raster blocks of the sheets that some tile still needs."""
    if not paths:
        return spark.createDataFrame([], "ord long, bx int, by int, rgba binary")
    paths = [(i, os.path.abspath(p)) for i, p in paths]
    named = spark.createDataFrame(paths, "ord long, name string")
    named = F.broadcast(named) if len(paths) <= MOST_SHEETS else named
    files = spark.read.format("binaryFile").load([p for _, p in paths]).select(F.regexp_replace("path", "^file:/*", "/").alias("name"), "content")
    return tiff.raster_blocks(files.join(named, "name"), RASTER_BLOCK)


def build_tileset(spark: SparkSession, source: str, out: str, *, bbox: tuple[float, float, float, float] | None = None, bbox_crs: str = "EPSG:4326", crs: LambertConformalConic | None = None, skip_blank: bool = False, **options) -> dict:
    """The tileset of one raster, cut to ``bbox`` if given; options as for :func:`build_mosaic`.

    ``bbox`` is west, south, east, north in degrees, or with ``bbox_crs="source"`` in the raster's
    own system, where a neatline is a rectangle.
    """
    if not os.path.isfile(source):
        raise FileNotFoundError(source)
    area = MapArea()
    if bbox is not None and bbox_crs == "source":
        area = MapArea(include=(Polygon("pixel", _pixels_of(tiff.read_header(source), bbox)),))
    elif bbox is not None and bbox_crs == "EPSG:4326":
        area = MapArea(limits=bbox)
    elif bbox is not None:
        raise ValueError(f"a box is given in EPSG:4326 or in the source's system, not in {bbox_crs}")
    return build_mosaic(spark, [MosaicSource(source, area, crs=crs)], out, skip_blank=skip_blank, **options)


def _pixels_of(h: tiff.Header, box: tuple[float, float, float, float]) -> tuple[tuple[float, float], ...]:
    """The corners of a box in a raster's own system, in its pixels."""
    if h.geotransform is None:
        raise TileBuildError("no coordinate system")
    g, (w, s, e, n) = h.geotransform, box
    det = g[1] * g[5] - g[2] * g[4]
    at = lambda x, y: ((g[5] * (x - g[0]) - g[2] * (y - g[3])) / det, (g[1] * (y - g[3]) - g[4] * (x - g[0])) / det)
    return at(w, n), at(e, n), at(e, s), at(w, s)
