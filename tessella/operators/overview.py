"""Overviews: each parent pixel is the alpha-weighted mean of its four child pixels."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.grid import parent
from tessella.functions.pixels import quantise
from tessella.functions.workers import ship


def parents(tiles: DataFrame) -> DataFrame:
    """Distinct parents of written tiles."""
    return tiles.select((F.col("z") - 1).cast("int").alias("z"), parent(F.col("x")).alias("x"), parent(F.col("y")).alias("y")).distinct()


def halve(pixels: DataFrame, size: int, colours: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """One level up: ``z, x, y, px, py`` with 8-bit colours and ``a``; tiles that show nothing go.

    Pixels that are absent count as transparent, so alpha is a quarter of the sum in any case.
    Sums are of whole numbers and combine before the shuffle.
    """
    up = lambda t, p: F.floor((F.col(t) % 2 * size + F.col(p)) / 2).cast("int")
    keyed = pixels.select((F.col("z") - 1).cast("int").alias("z"), parent(F.col("x")).alias("x"), parent(F.col("y")).alias("y"), up("x", "px").alias("px"), up("y", "py").alias("py"), *colours, "a")
    keys = ["z", "x", "y", "px", "py"]
    summed = keyed.groupBy(*keys).agg(*(F.sum(F.col(c) * F.col("a")).alias(f"s{c}") for c in colours), F.sum("a").alias("sa"))
    weight = F.when(F.col("sa") > 0, F.col("sa"))
    made = summed.select(*keys, *(F.coalesce(quantise(F.col(f"s{c}") / weight), F.lit(0)).alias(c) for c in colours), quantise(F.col("sa") / 4).alias("a"))
    shown = made.groupBy("z", "x", "y").agg(F.max("a").alias("__a")).where("__a > 0").select("z", "x", "y")
    return made.join(shown, ["z", "x", "y"], "left_semi")


def cascade(tiles: DataFrame, top: int, low: int, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Keys of all levels from ``top`` down to ``low``; ``keep`` may write each level (a checkpoint)."""
    level = tiles.where(F.col("z") == top).select("z", "x", "y").distinct()
    found = level
    for _ in range(low, top):
        level = parents(level)
        level = keep(level) if keep else level
        found = found.union(level)
    return found


def children_of(tiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The tiles whose parent is in ``wanted`` (z, x, y)."""
    keys = wanted.select((F.col("z") + 1).cast("int").alias("z"), F.col("x").alias("_px"), F.col("y").alias("_py"))
    placed = tiles.withColumn("_px", parent(F.col("x"))).withColumn("_py", parent(F.col("y")))
    return placed.join(keys, ["z", "_px", "_py"], "left_semi").drop("_px", "_py")


def box_reduce(pixels: DataFrame, keys: list[str], factor: int, colour: str = "c", alpha: str = "a") -> DataFrame:
    """Means of premultiplied colour and of alpha over boxes of ``factor`` by ``factor``."""
    box = lambda p: F.floor(F.col(p) / factor).cast("int").alias(p)
    cells = pixels.select(*keys, box("px"), box("py"), (F.col(colour) * F.col(alpha)).alias("__c"), F.col(alpha).alias("__a"))
    n = factor * factor
    return cells.groupBy(*keys, "px", "py").agg((F.sum("__c") / n / 65025.0).alias("pc"), (F.sum("__a") / n / 255.0).alias("pa"))


def halve_packed(tiles: DataFrame, size: int) -> DataFrame:
    """One level up for packed RGBA tiles: ``z, x, y, rgba``; four children meet in a group."""

    def averaged(table: pa.Table) -> pa.Table:
        whole = np.zeros((2 * size, 2 * size, 4), np.int64)
        for x, y, packed in zip(*(table.column(n).to_pylist() for n in ("x", "y", "rgba")), strict=True):
            dx, dy = x % 2 * size, y % 2 * size
            whole[dy : dy + size, dx : dx + size] = np.frombuffer(packed, np.uint8).reshape(size, size, 4)
        boxes = whole.reshape(size, 2, size, 2, 4)
        total = boxes[..., 3].sum(axis=(1, 3))
        weighted = (boxes[..., :3] * boxes[..., 3:]).sum(axis=(1, 3))
        colour = np.where(total[..., None] > 0, np.rint(weighted / np.maximum(total, 1)[..., None]), 0)
        alpha = np.rint(total / 4)
        shown = bool(alpha.max() > 0)
        rgba = np.concatenate([colour, alpha[..., None]], axis=2).astype(np.uint8).tobytes()
        first = [table.column(n)[0].as_py() for n in ("z", "x", "y")]
        row = [[first[0] - 1], [first[1] >> 1], [first[2] >> 1], [rgba]] if shown else [[], [], [], []]
        return pa.table([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["z", "x", "y", "rgba"])

    ship(tiles.sparkSession)
    keyed = tiles.select("z", "x", "y", "rgba", parent(F.col("x")).alias("__px"), parent(F.col("y")).alias("__py"))
    return keyed.groupBy("z", "__px", "__py").applyInArrow(averaged, "z int, x long, y long, rgba binary")
