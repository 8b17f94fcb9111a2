"""Tile grids as Column expressions: ranges, bounds, keys.

A key is ``(z, x, y)`` with y counted from the north (XYZ).  ``EPS`` keeps a coordinate that lies
on a tile edge from spilling into the next tile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPS = 1e-9
#: Half the world in Mercator metres, the sphere's radius, the grid's last latitude.
HALF_WORLD = 20037508.342789244
RADIUS = 6378137.0
MAX_LATITUDE = 85.0511287798066
TILE_SIZE = 256
BLOCK_TILES = 8
#: Worst interpolation error of a 16 pixel lattice, in source pixels.
LATTICE_ERROR = 1.2e-4


def _long(c: Column) -> Column:
    return c.cast("long")


def shifted(base: int | Column, z: Column) -> Column:
    return F.call_function("shiftleft", F.lit(base) if isinstance(base, int) else base, z.cast("int"))


@dataclass(frozen=True)
class Scheme:
    """A tiling scheme; methods take and give Columns."""

    name: str
    crs: str
    west: float
    south: float
    east: float
    north: float
    base_columns: int
    base_rows: int
    tile_size: int = TILE_SIZE

    def columns(self, z: Column) -> Column:
        return shifted(self.base_columns, z)

    def rows(self, z: Column) -> Column:
        return shifted(self.base_rows, z)

    def span_x(self, z: Column) -> Column:
        return F.lit(self.east - self.west) / self.columns(z)

    def span_y(self, z: Column) -> Column:
        return F.lit(self.north - self.south) / self.rows(z)

    def resolution(self, z: Column) -> Column:
        return self.span_x(z) / self.tile_size

    def tile_bounds(self, z: Column, x: Column, y: Column) -> Column:
        sx, sy = self.span_x(z), self.span_y(z)
        return F.struct((self.west + x * sx).alias("west"), (self.north - (y + 1) * sy).alias("south"), (self.west + (x + 1) * sx).alias("east"), (self.north - y * sy).alias("north"))

    def flip_y(self, z: Column, y: Column) -> Column:
        """XYZ row to TMS row and back."""
        return self.rows(z) - 1 - y

    def zoom_for_resolution(self, resolution: Column) -> Column:
        """The first zoom at least as fine; rounds up unless within EPS; an error if not positive."""
        base = (self.east - self.west) / (self.base_columns * self.tile_size)
        z = F.greatest(F.lit(0).cast("long"), _long(F.ceil(F.log2(base / resolution) - EPS)))
        return F.when(resolution <= 0, F.raise_error(F.lit("resolution must be positive")).cast("long")).otherwise(z)

    def _spread(self, low: Column, high: Column, span: Column, count: Column) -> tuple[Column, Column]:
        first = F.least(F.greatest(_long(F.floor(low / span + EPS)), F.lit(0).cast("long")), count - 1)
        last = F.least(F.greatest(_long(F.ceil(high / span - EPS)) - 1, F.lit(0).cast("long")), count - 1)
        return first, F.greatest(first, last)

    def tile_range(self, z: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
        """Inclusive range of tiles, clamped to the grid; an error for empty bounds."""
        x = self._spread(west - self.west, east - self.west, self.span_x(z), self.columns(z))
        y = self._spread(self.north - north, self.north - south, self.span_y(z), self.rows(z))
        found = F.struct(z.cast("int").alias("z"), _long(x[0]).alias("x_min"), _long(x[1]).alias("x_max"), _long(y[0]).alias("y_min"), _long(y[1]).alias("y_max"))
        empty = (east <= west) | (north <= south)
        return F.when(empty, F.raise_error(F.lit("bounds are empty")).cast("struct<z:int,x_min:bigint,x_max:bigint,y_min:bigint,y_max:bigint>")).otherwise(found)

    def tile_of(self, z: Column, px: Column, py: Column) -> Column:
        """Tile of a point, clamped to the grid."""
        x = F.least(F.greatest(_long(F.floor((px - self.west) / self.span_x(z))), F.lit(0).cast("long")), _long(self.columns(z) - 1))
        y = F.least(F.greatest(_long(F.floor((self.north - py) / self.span_y(z))), F.lit(0).cast("long")), _long(self.rows(z) - 1))
        return F.struct(x.alias("x"), y.alias("y"))

    def clamp_bounds(self, west: Column, south: Column, east: Column, north: Column) -> Column:
        """Bounds within the world; an error if they miss it."""
        w, s = F.greatest(west, F.lit(self.west)), F.greatest(south, F.lit(self.south))
        e, n = F.least(east, F.lit(self.east)), F.least(north, F.lit(self.north))
        found = F.struct(w.alias("west"), s.alias("south"), e.alias("east"), n.alias("north"))
        return F.when((e <= w) | (n <= s), F.raise_error(F.lit("bounds miss the world")).cast("struct<west:double,south:double,east:double,north:double>")).otherwise(found)


MERCATOR = Scheme("mercator", "EPSG:3857", -HALF_WORLD, -HALF_WORLD, HALF_WORLD, HALF_WORLD, 1, 1)
GEOGRAPHIC = Scheme("geographic", "EPSG:4326", -180.0, -90.0, 180.0, 90.0, 2, 1)
SCHEMES = {s.name: s for s in (MERCATOR, GEOGRAPHIC)}


def schemes(spark: SparkSession) -> DataFrame:
    """The schemes as a dimension table."""
    rows = [(s.name, s.crs, s.west, s.south, s.east, s.north, s.base_columns, s.base_rows, s.tile_size) for s in SCHEMES.values()]
    return spark.createDataFrame(rows, "name string, crs string, west double, south double, east double, north double, base_columns int, base_rows int, tile_size int")


def range_width(r: Column) -> Column:
    return r["x_max"] - r["x_min"] + 1


def range_height(r: Column) -> Column:
    return r["y_max"] - r["y_min"] + 1


def range_count(r: Column) -> Column:
    return range_width(r) * range_height(r)


def range_tiles(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``x, y`` of every tile of the range, row by row."""
    down = df.withColumn("y", F.explode(F.sequence(F.col(f"{column}.y_min"), F.col(f"{column}.y_max"))))
    return down.withColumn("x", F.explode(F.sequence(F.col(f"{column}.x_min"), F.col(f"{column}.x_max"))))


def parent(x: Column) -> Column:
    return F.shiftright(x, 1)


def block_of(x: Column, size: int = BLOCK_TILES) -> Column:
    return x - F.pmod(x, F.lit(size))


def mip_factor(scale: Column) -> Column:
    """The power of two at or below ``scale``; 1 below 2."""
    return F.when(scale < 2, F.lit(1).cast("long")).otherwise(_long(F.pow(F.lit(2.0), F.floor(F.log2(scale)))))


def lattice_step(tolerance: Column, size: int = TILE_SIZE, cap: int = 16) -> Column:
    """Lattice spacing in pixels for a tolerance in source pixels: a power of two up to ``cap``.

    The interpolation error goes with the square of the spacing and is LATTICE_ERROR at 16 pixels,
    which is the tightest that is used.
    """
    widest = F.least(16 * F.sqrt(tolerance / LATTICE_ERROR), F.lit(float(min(size, cap))))
    loose = F.greatest(F.lit(1).cast("long"), _long(F.pow(F.lit(2.0), F.floor(F.log2(widest)))))
    return F.when(tolerance <= LATTICE_ERROR, F.lit(min(16, cap, size)).cast("long")).otherwise(loose)


def blocks(df: DataFrame, total: str, size: int) -> DataFrame:
    """``df`` with ``offset, length`` of each block of ``total`` units."""
    starts = F.sequence(F.lit(0).cast("long"), F.col(total).cast("long") - 1, F.lit(size).cast("long"))
    return df.where(F.col(total) > 0).withColumn("offset", F.explode(starts)).withColumn("length", F.least(F.lit(size).cast("long"), F.col(total) - F.col("offset")))
