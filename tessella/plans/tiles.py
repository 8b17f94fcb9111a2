"""Planning: which sheets reach which tiles.

The footprint-by-tile join is never a range join: each footprint is exploded into rows, each row
into the columns of the footprint's extent there, and the rest is keyed on (z, x, y).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.grid import BLOCK_TILES, EPS, Scheme, block_of


def strip_extent(ring: Column, low: Column, high: Column) -> Column:
    """x-extent of a ring within ``low <= y <= high``; null fields if they do not meet."""

    def crossings(p: Column, i: Column) -> Column:
        q = F.get(ring, F.pmod(i + 1, F.size(ring)))
        at = lambda y: F.when(q["y"] == p["y"], p["x"]).otherwise(p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / F.when(q["y"] != p["y"], q["y"] - p["y"]))
        held = lambda y: F.least(F.greatest(y, low), high)
        flat = q["y"] == p["y"]
        ends = F.when(flat, F.array(p["x"], q["x"])).otherwise(F.array(at(held(p["y"])), at(held(q["y"]))))
        meets = (F.least(p["y"], q["y"]) <= high) & (F.greatest(p["y"], q["y"]) >= low)
        return F.when(meets, ends).otherwise(F.array().cast("array<double>"))

    xs = F.flatten(F.transform(ring, crossings))
    return F.struct(F.array_min(xs).alias("west"), F.array_max(xs).alias("east"))


def plan_tiles(footprints: DataFrame, scheme: Scheme, z: int) -> DataFrame:
    """One row per sheet and tile: ``z, x, y, wrap`` and the columns of ``footprints``.

    ``footprints`` has ``ring``, an array of (x, y) in the scheme's units, unwrapped, so x may lie
    beyond the world; ``wrap`` counts the worlds.  A tile may be planned that the sheet just
    misses (a notch), never the other way round.
    """
    span_x = (scheme.east - scheme.west) / (scheme.base_columns << z)
    span_y = (scheme.north - scheme.south) / (scheme.base_rows << z)
    columns, rows = scheme.base_columns << z, scheme.base_rows << z
    y_of = F.transform("ring", lambda p: p["y"])
    first = F.greatest(F.floor((scheme.north - F.array_max(y_of)) / span_y + EPS), F.lit(0))
    last = F.least(F.ceil((scheme.north - F.array_min(y_of)) / span_y - EPS) - 1, F.lit(rows - 1))
    down = footprints.withColumn("__last", last.cast("long")).withColumn("__first", first.cast("long")).where("__last >= __first").withColumn("y", F.explode(F.sequence("__first", "__last")))
    extent = strip_extent(F.col("ring"), F.lit(scheme.north) - (F.col("y") + 1) * span_y, F.lit(scheme.north) - F.col("y") * span_y)
    strips = down.withColumn("__e", extent).where("__e.east > __e.west")
    left = F.floor((F.col("__e.west") - scheme.west) / span_x + EPS).cast("long")
    right = F.greatest(left, (F.ceil((F.col("__e.east") - scheme.west) / span_x - EPS) - 1).cast("long"))
    across = strips.withColumn("__x", F.explode(F.sequence(left, right)))
    wrap = F.floor(F.col("__x") / columns).cast("long")
    return across.select(*footprints.columns, F.lit(z).alias("z"), F.pmod(F.col("__x"), F.lit(columns)).cast("long").alias("x"), F.col("y").cast("long").alias("y"), wrap.alias("wrap"))


def contributors(plan: DataFrame, order: str = "ord") -> DataFrame:
    """Per tile: the ordered list of ``(order, wrap)`` and its length."""
    listed = F.array_sort(F.collect_set(F.struct(F.col(order), F.col("wrap"))))
    return plan.groupBy("z", "x", "y").agg(listed.alias("layers")).withColumn("n", F.size("layers"))


def seams_last(tiles: DataFrame) -> DataFrame:
    """Tiles of one contributor before tiles of several."""
    return tiles.orderBy(F.col("n") > 1, "y", "x")


def plan_detail(plan: DataFrame, flag: str = "detail") -> DataFrame:
    """The rows of tiles that a detail sheet reaches; all their contributors stay."""
    return plan.join(plan.where(F.col(flag)).select("z", "x", "y").distinct(), ["z", "x", "y"], "left_semi")


def plan_blocks(plan: DataFrame, size: int = BLOCK_TILES) -> DataFrame:
    """Per block of tiles: tiles, contributors, and the distinct layers to warp once."""
    at = plan.withColumn("bx", block_of(F.col("x"), size)).withColumn("by", block_of(F.col("y"), size))
    return at.groupBy("z", "bx", "by").agg(F.count_distinct("x", "y").alias("tiles"), F.count("*").alias("rows"), F.array_sort(F.collect_set(F.struct("ord", "wrap"))).alias("layers"))


def resume(plan: DataFrame, written: DataFrame) -> DataFrame:
    """The plan without tiles that exist."""
    return plan.join(written.select("z", "x", "y").distinct(), ["z", "x", "y"], "left_anti")


#: Bytes of one seam tile's running colour and alpha: four half floats a pixel.
SEAM_BYTES = 4 * 2 * 256 * 256


def seam_slots(seams: Column, budget: Column | int) -> Column:
    """Seam tiles that may be open at once within ``budget`` bytes."""
    return F.greatest(F.lit(0).cast("long"), F.least(seams, F.floor((F.lit(budget) if isinstance(budget, int) else budget) / SEAM_BYTES)))


def window_starts(windows: DataFrame, by: str = "ord", size: str = "tiles") -> DataFrame:
    """Blocks of each sheet in order with ``start``, the tiles of all blocks before."""
    order = Window.partitionBy(by).orderBy("z", "by", "bx").rowsBetween(Window.unboundedPreceding, -1)
    return windows.withColumn("start", F.coalesce(F.sum(size).over(order), F.lit(0)))


def first_blocks(blocks: DataFrame, n: int, sheet: str = "ord") -> DataFrame:
    """The first ``n`` blocks of each sheet, row by row, for a trial."""
    order = Window.partitionBy(sheet).orderBy("by", "bx")
    return blocks.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def source_windows(plan: DataFrame, scheme: Scheme, to_source, steps: int = 4) -> DataFrame:
    """``plan`` with ``col_min, col_max, row_min, row_max``: the source pixels that each tile comes from.

    ``to_source(x, y)`` takes the scheme's units to source pixels; it is followed at ``steps`` by ``steps``
    places and the tile's outer edges.
    """
    columns, rows = scheme.columns(F.col("z")), scheme.rows(F.col("z"))
    across, down = F.lit(scheme.east - scheme.west) / columns, F.lit(scheme.north - scheme.south) / rows
    at = F.sequence(F.lit(0), F.lit(steps))

    def place(i: Column, j: Column) -> Column:
        x = scheme.west + (F.col("x") + F.col("wrap") * columns + i / F.lit(steps)) * across
        y = scheme.north - (F.col("y") + j / F.lit(steps)) * down
        c, r = to_source(x, y)
        return F.struct(c.alias("c"), r.alias("r"))

    points = F.flatten(F.transform(at, lambda i: F.transform(at, lambda j: place(i, j))))
    ends = lambda f, name: f(F.transform("_p", lambda p: p[name]))
    met = plan.withColumn("_p", points)
    return met.select(*plan.columns, ends(F.array_min, "c").alias("col_min"), ends(F.array_max, "c").alias("col_max"), ends(F.array_min, "r").alias("row_min"), ends(F.array_max, "r").alias("row_max"))


def chunk_windows(windows: DataFrame, by: list[str], factor: Column, margin: int = 12) -> DataFrame:
    """Per chunk of tiles one window that holds all of theirs, with a margin, on whole boxes of ``factor`` pixels."""
    found = windows.groupBy(*by).agg(F.min("col_min").alias("a"), F.max("col_max").alias("b"), F.min("row_min").alias("c"), F.max("row_max").alias("d"), F.max(factor).alias("f"))
    low = lambda v: (F.floor((F.col(v) - margin * F.col("f")) / F.col("f")) * F.col("f")).cast("long")
    high = lambda v: (F.ceil((F.col(v) + margin * F.col("f")) / F.col("f")) * F.col("f")).cast("long")
    return found.select(*by, low("a").alias("col_min"), high("b").alias("col_max"), low("c").alias("row_min"), high("d").alias("row_max"), F.col("f").cast("long").alias("factor"))
