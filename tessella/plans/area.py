"""Map areas as predicates: image and limits and (any include) and not (any exclude)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POLYGON = "struct<frame:string,points:array<struct<x:double,y:double>>>"
AREA = f"struct<limits:struct<west:double,south:double,east:double,north:double>,include:array<{POLYGON}>,exclude:array<{POLYGON}>>"


def inside_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd test of a point against a closed ring."""

    def crosses(p: Column, i: Column) -> Column:
        q = F.get(ring, F.pmod(i + 1, F.size(ring)))
        up = (p["y"] > y) != (q["y"] > y)
        at = p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / F.when(q["y"] != p["y"], q["y"] - p["y"])
        return F.when(up & (x < at), 1).otherwise(0)

    hits = F.aggregate(F.transform(ring, crosses), F.lit(0), lambda a, v: a + v)
    return hits % 2 == 1


def in_limits(limits: Column, lon: Column, lat: Column) -> Column:
    """Within the sides that are given; a null side is open."""
    side = lambda name, test: F.coalesce(test(limits[name]), F.lit(True))
    return side("west", lambda v: lon >= v) & side("east", lambda v: lon <= v) & side("south", lambda v: lat >= v) & side("north", lambda v: lat <= v)


def in_area(area: Column, col: Column, row: Column, lon: Column, lat: Column, width: Column, height: Column) -> Column:
    """Whether a pixel's centre belongs to the map area of its sheet.

    Polygons are in pixels or in degrees by their frame; without include polygons the image counts.
    """
    of = lambda p: F.when(p["frame"] == "pixel", inside_ring(p["points"], col, row)).otherwise(inside_ring(p["points"], lon, lat))
    image = (col >= 0) & (col <= width) & (row >= 0) & (row <= height)
    include = F.coalesce(F.size(area["include"]) <= 0, F.lit(True)) | F.exists(F.coalesce(area["include"], F.array().cast(f"array<{POLYGON}>")), of)
    exclude = F.exists(F.coalesce(area["exclude"], F.array().cast(f"array<{POLYGON}>")), of)
    limits = F.when(area["limits"].isNull(), F.lit(True)).otherwise(in_limits(area["limits"], lon, lat))
    return image & limits & include & ~exclude


def scaled(area: Column, scale: Column) -> Column:
    """Pixel polygons times ``scale``; polygons in degrees as they are."""
    points = lambda p: F.transform(p["points"], lambda v: F.when(p["frame"] == "pixel", F.struct((v["x"] * scale).alias("x"), (v["y"] * scale).alias("y"))).otherwise(v))
    each = lambda name: F.transform(area[name], lambda p: F.struct(p["frame"].alias("frame"), points(p).alias("points"))).alias(name)
    return F.struct(area["limits"].alias("limits"), each("include"), each("exclude"))


def from_manifest(text: Column, scale: Column | None = None) -> Column:
    """Map areas of a manifest: JSON text to map of sheet name to area; unknown keys are ignored.

    In the file, a polygon is ``{"pixel": [[x, y], ...]}`` or ``{"lonlat": ...}``.
    """
    kind = "array<struct<pixel:array<array<double>>,lonlat:array<array<double>>>>"
    raw = F.from_json(text, f"map<string,struct<limits:struct<west:double,south:double,east:double,north:double>,include:{kind},exclude:{kind},manual:boolean>>")
    ring = lambda p: F.transform(F.coalesce(p["pixel"], p["lonlat"]), lambda v: F.struct(v[0].alias("x"), v[1].alias("y")))
    polygons = lambda a: F.transform(a, lambda p: F.struct(F.when(p["pixel"].isNotNull(), "pixel").otherwise("lonlat").alias("frame"), ring(p).alias("points")))

    def area(v: Column) -> Column:
        made = F.struct(v["limits"].alias("limits"), polygons(v["include"]).alias("include"), polygons(v["exclude"]).alias("exclude"))
        return made if scale is None else scaled(made, scale)

    return F.transform_values(raw, lambda _, v: area(v))
