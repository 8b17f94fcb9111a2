"""Compositing overlapping layers of a pixel, the topmost first.

Rows are pixels with ``ord`` (greater is above), colour 0..255 and alpha 0..1.  The closed form of
painting under: a layer shows through the product of what the layers above let pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.pixels import BLANK, OPAQUE, finish_alpha, finish_colour
from tessella.functions.workers import ship


def passing(keys: Sequence[str], alpha: str = "a", order: str = "ord") -> Column:
    """What the layers above a row let pass; 1 for the topmost."""
    above = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.product(1 - F.col(alpha)).over(above), F.lit(1.0))


def composite(layers: DataFrame, keys: Sequence[str], colours: Sequence[str] = ("r", "g", "b"), alpha: str = "a", order: str = "ord") -> DataFrame:
    """Per key: premultiplied colours ``p<colour>`` and alpha ``pa``.

    Layers under a pixel that is opaque already are dropped before they are summed.
    """
    seen = layers.withColumn("__t", passing(keys, alpha, order)).where(F.col("__t") > OPAQUE)
    weight = F.col("__t") * F.col(alpha)
    return seen.groupBy(*keys).agg(*(F.sum(weight * F.col(c)).alias(f"p{c}") for c in colours), F.sum(weight).alias("pa"))


def folded(layers: DataFrame, keys: Sequence[str], colour: str = "c", alpha: str = "a", order: str = "ord") -> DataFrame:
    """The same for one colour by a fold over each key's sorted layers, without a window."""
    listed = layers.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("ord"), F.col(colour).cast("double").alias("c"), F.col(alpha).cast("double").alias("a"))), asc=False).alias("s"))
    start = F.struct(F.lit(0.0).alias("c"), F.lit(0.0).alias("a"))
    step = lambda acc, v: F.struct((acc["c"] + (1 - acc["a"]) * v["a"] * v["c"]).alias("c"), (acc["a"] + (1 - acc["a"]) * v["a"]).alias("a"))
    return listed.withColumn("f", F.aggregate("s", start, step)).select(*keys, F.col("f.c").alias(f"p{colour}"), F.col("f.a").alias("pa"))


def finish(pixels: DataFrame, keys: Sequence[str], colours: Sequence[str] = ("r", "g", "b")) -> DataFrame:
    """8-bit straight colours and alpha from premultiplied ones."""
    return pixels.select(*keys, *(finish_colour(F.col(f"p{c}"), F.col("pa")).alias(c) for c in colours), finish_alpha(F.col("pa")).alias("a"))


def drop_blank(pixels: DataFrame, tile: Sequence[str] = ("z", "x", "y"), alpha: str = "pa") -> DataFrame:
    """Pixels of tiles that show anything at all."""
    shown = pixels.groupBy(*tile).agg(F.max(alpha).alias("__most")).where(F.col("__most") > BLANK).select(*tile)
    return pixels.join(shown, list(tile), "left_semi")


def composite_packed(layers: DataFrame, size: int, skip_blank: bool = True) -> DataFrame:
    """Whole tiles: ``z, x, y, ord, rgba`` (packed 8-bit RGBA) to ``z, x, y, nbytes, rgba``; blanks go if they are to be skipped.

    A tile's few layers are held in one task, one group at a time.
    """

    def merged(table: pa.Table) -> pa.Table:
        tiles = sorted(zip(table.column("ord").to_pylist(), table.column("rgba").to_pylist(), strict=True), key=lambda v: -v[0])
        colour, alpha = np.zeros((size, size, 3)), np.zeros((size, size, 1))
        for _, packed in tiles:
            layer = np.frombuffer(packed, np.uint8).reshape(size, size, 4).astype(float)
            a = layer[..., 3:] / 255
            colour += (1 - alpha) * a * layer[..., :3]
            alpha += (1 - alpha) * a
            if alpha.min() >= 1 - OPAQUE:
                break
        out = table.slice(0, 1).select(["z", "x", "y"])
        if skip_blank and alpha.max() <= BLANK:
            out = out.slice(0, 0)
            return out.append_column("nbytes", pa.array([], pa.int64())).append_column("rgba", pa.array([], pa.binary()))
        straight = np.where(alpha > 0, np.rint(np.clip(colour / np.where(alpha > 0, alpha, 1), 0, 255)), 0)
        rgba = np.concatenate([straight, np.rint(alpha * 255)], axis=2).astype(np.uint8).tobytes()
        return out.append_column("nbytes", pa.array([len(rgba)], pa.int64())).append_column("rgba", pa.array([rgba], pa.binary()))

    ship(layers.sparkSession)
    return layers.select("z", "x", "y", "ord", "rgba").groupBy("z", "x", "y").applyInArrow(merged, "z int, x long, y long, nbytes long, rgba binary")
