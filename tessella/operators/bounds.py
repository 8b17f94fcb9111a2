"""Extents: the covering arc of longitudes, data bounds, bounds from tile extents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.geo import arc_centre, normalise, x_to_lon, y_to_lat
from tessella.functions.grid import MERCATOR


def covering_arc(intervals: DataFrame, keys: list[str], low: str = "lo", high: str = "hi") -> DataFrame:
    """Per group the shortest arc ``west, east`` that covers all intervals of longitude.

    ``west > east`` crosses the antimeridian.  An interval of a full turn, or no gap at all, gives
    the whole world; of equally wide gaps the first counts.
    """
    start = F.pmod(F.col(low) + 180, F.lit(360.0)) - 180
    rows = intervals.select(*keys, start.alias("lo"), (start + F.col(high) - F.col(low)).alias("hi"), (F.col(high) - F.col(low) >= 360).alias("full"))
    order = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("new", F.when(F.col("lo") <= reach, 0).otherwise(1)).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = marked.groupBy(*keys, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("full").alias("full"))
    by_run = Window.partitionBy(*keys).orderBy("run")
    whole = Window.partitionBy(*keys)
    last = F.lead("lo").over(by_run).isNull()
    gaps = runs.select(
        *keys,
        "run",
        F.max("full").over(whole).alias("full"),
        F.when(last, F.min("lo").over(whole) + 360 - F.max("hi").over(whole)).otherwise(F.lead("lo").over(by_run) - F.col("hi")).alias("gap"),
        F.when(last, F.min("lo").over(whole)).otherwise(F.lead("lo").over(by_run)).alias("west"),
        F.when(last, F.max("hi").over(whole)).otherwise(F.col("hi")).alias("east"),
    )
    widest = gaps.groupBy(*keys).agg(F.max("full").alias("full"), F.max_by(F.struct("gap", "west", "east"), F.struct(F.col("gap"), -F.col("run"))).alias("__widest"))
    world = F.col("full") | (F.col("__widest.gap") <= 0)
    return widest.select(*keys, F.when(world, F.lit(-180.0)).otherwise(normalise(F.col("__widest.west"))).alias("west"), F.when(world, F.lit(180.0)).otherwise(normalise(F.col("__widest.east"))).alias("east"))


def data_bounds(sheets: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: west, south, east, north and the centre of all sheets' ``lon_lo .. lat_hi``."""
    lats = sheets.groupBy(*keys).agg(F.min("lat_lo").alias("south"), F.max("lat_hi").alias("north"))
    arcs = covering_arc(sheets, keys, "lon_lo", "lon_hi")
    both = arcs.join(lats, keys) if keys else arcs.join(F.broadcast(lats))  # one row each
    return both.select(*keys, "west", "south", "east", "north", arc_centre(F.col("west"), F.col("east")).alias("centre_lon"), ((F.col("south") + F.col("north")) / 2).alias("centre_lat"))


def mercator_bounds(extent: DataFrame) -> DataFrame:
    """``extent`` (z, x_min, x_max, y_min, y_max) with the degrees of its outer edges."""
    low = MERCATOR.tile_bounds(F.col("z"), F.col("x_min"), F.col("y_max"))
    high = MERCATOR.tile_bounds(F.col("z"), F.col("x_max"), F.col("y_min"))
    return extent.select("*", x_to_lon(low["west"]).alias("west"), y_to_lat(low["south"]).alias("south"), x_to_lon(high["east"]).alias("east"), y_to_lat(high["north"]).alias("north"))


def imagery_extent(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Bounds for a viewer without antimeridian support: the full band, a hair inside, if they cross."""
    cross = west > east
    return F.struct(F.when(cross, F.lit(-180 + 1e-5)).otherwise(west).alias("west"), south.alias("south"), F.when(cross, F.lit(180 - 1e-5)).otherwise(east).alias("east"), north.alias("north"))


def clipped(a: Column, b: Column) -> Column:
    """What two boxes have in common; null where they only touch or lie apart."""
    w, s, e, n = F.greatest(a["west"], b["west"]), F.greatest(a["south"], b["south"]), F.least(a["east"], b["east"]), F.least(a["north"], b["north"])
    return F.when((w < e) & (s < n), F.struct(w.alias("west"), s.alias("south"), e.alias("east"), n.alias("north")))
