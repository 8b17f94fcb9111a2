"""Projections and affine maps as Column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.grid import EPS, HALF_WORLD, MAX_LATITUDE, MERCATOR, RADIUS

DENSIFY_DEGREES = 0.01


def lon_to_x(lon: Column) -> Column:
    """Longitude to Mercator x; multiplied first, as everywhere, for a place on a tile's edge hangs on the last bit."""
    return lon * HALF_WORLD / 180


def x_to_lon(x: Column) -> Column:
    return x * (180 / HALF_WORLD)


def lat_to_y(lat: Column) -> Column:
    """Latitude to Mercator y, clamped to the square grid."""
    held = F.least(F.greatest(lat, F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE))
    return RADIUS * F.log(F.tan(math.pi / 4 + F.radians(held) / 2))


def y_to_lat(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2)


def unwrap(lon: Column, centre: Column) -> Column:
    """The copy of ``lon`` within half a turn of ``centre``."""
    return centre + F.pmod(lon - centre + 180, F.lit(360.0)) - 180


def normalise(lon: Column) -> Column:
    """``lon`` turned into [-180, 180]; values at the antimeridian stay as they are."""
    return F.when((lon >= -180) & (lon <= 180), lon).when(lon > 180, lon - 360 * F.ceil((lon - 180) / 360)).otherwise(lon + 360 * F.ceil((-180 - lon) / 360))


def arc_centre(west: Column, east: Column) -> Column:
    """The middle of the arc from ``west`` to ``east``, which may cross the antimeridian."""
    width = F.when(east >= west, east - west).otherwise(east - west + 360)
    return normalise(west + width / 2)


def apply_affine(gt: Column, col: Column, row: Column) -> Column:
    """Pixel to CRS by the six terms ``(x0, dx, rx, y0, ry, dy)``."""
    return F.struct((gt[0] + gt[1] * col + gt[2] * row).alias("x"), (gt[3] + gt[4] * col + gt[5] * row).alias("y"))


def invert_affine(gt: Column) -> Column:
    """The inverse terms; null if the map is singular."""
    det = gt[1] * gt[5] - gt[2] * gt[4]
    d = F.when(det != 0, det)
    return F.when(det != 0, F.array((gt[2] * gt[3] - gt[0] * gt[5]) / d, gt[5] / d, -gt[2] / d, (gt[0] * gt[4] - gt[1] * gt[3]) / d, -gt[4] / d, gt[1] / d))


def rescale_affine(gt: Column, scale: Column) -> Column:
    """Terms for an image ``scale`` times as fine; rotation is scaled as well."""
    return F.transform(gt, lambda v, i: F.when(i.isin(1, 2, 4, 5), v / scale).otherwise(v))


def source_extent(gt: Column, width: Column, height: Column) -> Column:
    """Bounds from an unrotated affine map; an error for the identity, which says nothing."""
    x1, y1 = gt[0] + gt[1] * width, gt[3] + gt[5] * height
    found = F.struct(F.least(gt[0], x1).alias("west"), F.least(gt[3], y1).alias("south"), F.greatest(gt[0], x1).alias("east"), F.greatest(gt[3], y1).alias("north"))
    identity = (gt[0] == 0) & (gt[1] == 1) & (gt[2] == 0) & (gt[3] == 0) & (gt[4] == 0) & (F.abs(gt[5]) == 1)
    return F.when(identity, F.raise_error(F.lit("no georeference")).cast("struct<west:double,south:double,east:double,north:double>")).otherwise(found)


def source_zoom(gt: Column, lat_lo: Column, lat_hi: Column) -> Column:
    """Native zoom from ground resolution at the latitude nearest the equator."""
    near = F.when((lat_lo <= 0) & (lat_hi >= 0), F.lit(0.0)).otherwise(F.least(F.abs(lat_lo), F.abs(lat_hi)))
    return MERCATOR.zoom_for_resolution(F.hypot(gt[1], gt[4]) / F.cos(F.radians(near)))


def rectangle_wkt(west: Column, south: Column, east: Column, north: Column) -> Column:
    corner = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(west, south), corner(east, south), corner(east, north), corner(west, north), corner(west, south)), F.lit("))"))


def box_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(point(west, south), point(east, south), point(east, north), point(west, north))


def map_points(ring: Column, function) -> Column:
    """Every vertex of a ring through ``function(x, y) -> (x, y)``."""

    def one(p: Column) -> Column:
        x, y = function(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(ring, one)


def densify(ring: Column, step: float = DENSIFY_DEGREES) -> Column:
    """The ring with each edge cut into equal parts of ``step`` at most."""

    def edge(p: Column, i: Column) -> Column:
        q = F.get(ring, F.pmod(i + 1, F.size(ring)))
        n = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(q["x"] - p["x"]), F.abs(q["y"] - p["y"])) / step - EPS).cast("int"))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct((p["x"] + (q["x"] - p["x"]) * k / n).alias("x"), (p["y"] + (q["y"] - p["y"]) * k / n).alias("y")))

    return F.flatten(F.transform(ring, edge))


def reproject_bounds(df: DataFrame, key: str, function, samples: int = 32) -> DataFrame:
    """Bounds of boxes ``west, south, east, north`` through ``function``, by points along all edges."""
    t = F.transform(F.sequence(F.lit(0), F.lit(samples)), lambda k: k / F.lit(samples))

    def side(f: Column) -> Column:
        x, y = F.col("west") + f * (F.col("east") - F.col("west")), F.col("south") + f * (F.col("north") - F.col("south"))
        points = [(x, F.col("south")), (x, F.col("north")), (F.col("west"), y), (F.col("east"), y)]
        out = [function(*p) for p in points]
        return F.array(*(F.struct(a.alias("x"), b.alias("y")) for a, b in out))

    points = df.select(key, F.flatten(F.transform(t, side)).alias("p"))
    of = lambda name: F.transform("p", lambda p: p[name])
    return points.select(key, F.array_min(of("x")).alias("west"), F.array_min(of("y")).alias("south"), F.array_max(of("x")).alias("east"), F.array_max(of("y")).alias("north"))


@dataclass(frozen=True)
class LambertConformalConic:
    """Lambert conformal conic with two standard parallels, on an ellipsoid (USGS PP 1395)."""

    lat_1: float
    lat_2: float
    lat_0: float
    lon_0: float
    false_easting: float = 0.0
    false_northing: float = 0.0
    semi_major: float = 6378137.0
    inverse_flattening: float = 298.257222101

    @property
    def eccentricity(self) -> float:
        f = 1 / self.inverse_flattening if self.inverse_flattening else 0.0
        return math.sqrt(f * (2 - f))

    def _m(self, lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (self.eccentricity * math.sin(lat)) ** 2)

    def _t(self, lat: float) -> float:
        es = self.eccentricity * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - es) / (1 + es)) ** (self.eccentricity / 2)

    def constants(self) -> tuple[float, float, float]:
        """n, F and the radius at the origin."""
        a, b = math.radians(self.lat_1), math.radians(self.lat_2)
        alike = math.isclose(a, b)
        n = math.sin(a) if alike else math.log(self._m(a) / self._m(b)) / math.log(self._t(a) / self._t(b))
        f = self._m(a) / (n * self._t(a) ** n)
        return n, f, self.semi_major * f * self._t(math.radians(self.lat_0)) ** n

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        n, f, rho_0 = self.constants()
        e = self.eccentricity
        phi = F.radians(lat)
        es = e * F.sin(phi)
        t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(e / 2))
        rho = self.semi_major * f * F.pow(t, F.lit(n))
        theta = n * F.radians(F.pmod(lon - self.lon_0 + 180, F.lit(360.0)) - 180)
        return self.false_easting + rho * F.sin(theta), self.false_northing + rho_0 - rho * F.cos(theta)

    @staticmethod
    def from_wkt(wkt: str) -> LambertConformalConic | None:
        """Parameters out of WKT 1; None if it is another projection."""
        import re

        if "Lambert_Conformal_Conic_2SP" not in wkt:
            return None
        found = {k.lower(): float(v) for k, v in re.findall(r'PARAMETER\["([^"]+)",\s*([-0-9.eE]+)', wkt)}
        body = re.search(r'SPHEROID\["[^"]*",\s*([-0-9.eE]+),\s*([-0-9.eE]+)', wkt)
        a, inv = (float(body[1]), float(body[2])) if body else (6378137.0, 298.257222101)
        return LambertConformalConic(found["standard_parallel_1"], found["standard_parallel_2"], found["latitude_of_origin"], found["central_meridian"], found.get("false_easting", 0.0), found.get("false_northing", 0.0), a, inv)


def on_lattice(at: Column, step: int, function) -> Column:
    """``function`` at ``at`` by its values at the multiples of ``step`` on either side."""
    low = F.floor(at / step) * step
    share = (at - low) / step
    return function(low.cast("double")) * (1 - share) + function((low + step).cast("double")) * share


def sampling_place(source: Column, size: Column) -> Column:
    """A source coordinate as -1..1 over the image, in which a sampler takes it."""
    return 2 * source / size - 1
