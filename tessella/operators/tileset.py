"""Summaries of a tileset: counts by zoom, extents, the metadata document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.geo import arc_centre
from tessella.operators.bounds import covering_arc, mercator_bounds


def per_zoom(tiles: DataFrame) -> DataFrame:
    """Per zoom: tiles, bytes and extent."""
    return tiles.groupBy("z").agg(F.count("*").alias("tiles"), F.sum("nbytes").alias("bytes"), F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max"))


def totals(by_zoom: DataFrame, detail_zoom: int | None = None) -> DataFrame:
    """One row: tiles, bytes, zooms, the highest zoom of full coverage, tiles by zoom."""
    full = F.col("z") < detail_zoom if detail_zoom is not None else F.lit(True)
    return by_zoom.agg(F.sum("tiles").alias("tiles"), F.sum("bytes").alias("bytes"), F.min("z").alias("minzoom"), F.max("z").alias("maxzoom"), F.max(F.when(full, F.col("z"))).alias("fullzoom"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("z").cast("string"), "tiles")))).alias("tiles_per_zoom"))


def extent(by_zoom: DataFrame, detail_zoom: int | None = None) -> DataFrame:
    """Bounds in degrees from the tiles of the highest full zoom."""
    full = by_zoom.where(F.col("z") < detail_zoom) if detail_zoom is not None else by_zoom
    top = full.agg(F.max_by(F.struct("z", "x_min", "x_max", "y_min", "y_max"), "z").alias("t")).select("t.*")
    return mercator_bounds(top)


def covered(tiles: DataFrame, by_zoom: DataFrame, detail_zoom: int | None = None) -> DataFrame:
    """Bounds in degrees of the tiles of the highest full zoom; they may cross the antimeridian."""
    top = extent(by_zoom, detail_zoom)
    columns = tiles.join(F.broadcast(top.select("z")), "z", "left_semi").select("z", "x").distinct()  # one row
    step = 360 / F.pow(F.lit(2.0), F.col("z"))
    arc = covering_arc(columns.select("z", (F.col("x") * step - 180).alias("lo"), ((F.col("x") + 1) * step - 180).alias("hi")), ["z"])
    return top.drop("west", "east").join(arc, "z").select("west", "south", "east", "north")


def covered_geographic(tiles: DataFrame, by_zoom: DataFrame, detail_zoom: int | None = None) -> DataFrame:
    """The same where tiles are boxes in degrees."""
    full = by_zoom.where(F.col("z") < detail_zoom) if detail_zoom is not None else by_zoom
    top = full.agg(F.max_by(F.struct("z", "y_min", "y_max"), "z").alias("t")).select("t.*")
    columns = tiles.join(F.broadcast(top.select("z")), "z", "left_semi").select("z", "x").distinct()  # one row
    step = 180 / F.pow(F.lit(2.0), F.col("z"))
    arc = covering_arc(columns.select("z", (F.col("x") * step - 180).alias("lo"), ((F.col("x") + 1) * step - 180).alias("hi")), ["z"])
    return top.join(arc, "z").select("west", (90 - (F.col("y_max") + 1) * step).alias("south"), "east", (90 - F.col("y_min") * step).alias("north"))


def metadata(total: DataFrame, bounds: DataFrame, data: DataFrame, *, name: str, source: str, tile_format: str, scheme: str, crs: str, native_zoom: int, sources: list[str] | None = None) -> DataFrame:
    """The metadata document as one row with column ``metadata`` (JSON); inputs have one row each."""
    r = lambda c: F.round(F.col(c), 8)
    b = bounds.select(F.array(r("west"), r("south"), r("east"), r("north")).alias("bounds"))
    d = data.select(F.array(r("west"), r("south"), r("east"), r("north")).alias("data_bounds"), arc_centre(F.col("west"), F.col("east")).alias("__lon"), ((F.col("south") + F.col("north")) / 2).alias("__lat"))
    row = total.join(F.broadcast(b)).join(F.broadcast(d))
    fields: list[Column] = [
        F.lit(name).alias("name"),
        F.lit(source).alias("source"),
        F.lit(tile_format).alias("format"),
        F.lit(scheme).alias("scheme"),
        F.lit(crs).alias("crs"),
        F.lit("xyz").alias("convention"),
        F.lit(256).alias("tilesize"),
        F.col("minzoom"),
        F.col("maxzoom"),
        F.lit(native_zoom).alias("nativezoom"),
        F.lit(f"{{z}}/{{x}}/{{y}}.{tile_format}").alias("url_template"),
        F.col("bounds"),
        F.col("data_bounds"),
        F.array(F.round("__lon", 8), F.round("__lat", 8), F.col("minzoom").cast("double")).alias("center"),
        F.col("tiles"),
        F.col("bytes"),
        F.col("tiles_per_zoom"),
    ]
    if sources is not None:
        fields += [F.array(*(F.lit(s) for s in sources)).alias("sources"), F.col("fullzoom")]
    return row.select(F.to_json(F.struct(*fields)).alias("metadata"))


def summary(total: DataFrame) -> DataFrame:
    """A line to read: tiles, megabytes, zooms."""
    return total.select(F.format_string("%d tiles, %.1f MB, zooms %d-%d", "tiles", F.col("bytes") / 1e6, "minzoom", "maxzoom").alias("summary"))
