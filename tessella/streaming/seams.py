"""Tiles with several contributors, assembled as their layers arrive.

A tile is complete by count, not by time: each layer tells how many its tile has, state keeps the
layers so far, and the tile is emitted once, when the last one is in.  A layer that comes twice
counts once.  Tiles that never complete stay in the state, so the end of input checks for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessella.functions.workers import ship
from tessella.sources.folders import new_folder

LAYER = "z int, x long, y long, ord long, a double, c double, n int"
TILE = "z int, x long, y long, pc double, pa double, n int"
STATE = "ords array<bigint>, alphas array<double>, colours array<double>"


def _arrived(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = dict(zip(state.get[0], zip(state.get[1], state.get[2], strict=True), strict=True)) if state.exists else {}
    n = 0
    for frame in frames:
        held |= {int(o): (float(a), float(c)) for o, a, c in zip(frame["ord"], frame["a"], frame["c"], strict=True)}
        n = int(frame["n"].max())
    if len(held) < n:
        state.update(([*held], [v[0] for v in held.values()], [v[1] for v in held.values()]))
        return
    if state.exists:
        state.remove()
    colour = alpha = 0.0
    for o in sorted(held, reverse=True):
        a, c = held[o]
        colour, alpha = colour + (1 - alpha) * a * c, alpha + (1 - alpha) * a
    yield pd.DataFrame({"z": [key[0]], "x": [key[1]], "y": [key[2]], "pc": [colour], "pa": [alpha], "n": [n]})


def assemble(layers: DataFrame) -> DataFrame:
    """A stream of layers (``LAYER``) to a stream of finished tiles (``TILE``)."""
    ship(layers.sparkSession)
    return layers.groupBy("z", "x", "y").applyInPandasWithState(_arrived, TILE, STATE, "append", GroupStateTimeout.NoTimeout)


def incomplete(expected: DataFrame, done: DataFrame) -> DataFrame:
    """Tiles (z, x, y) that were expected and aren't done."""
    return expected.select("z", "x", "y").join(done.select("z", "x", "y"), ["z", "x", "y"], "left_anti")


def assembled(spark: SparkSession, layers: DataFrame, batches: int = 3) -> DataFrame:
    """Run a table of layers ``z, x, y, ord, a, c`` through the stream in several batches.

    Raises if a tile never got all its layers.
    """
    counts = layers.groupBy("z", "x", "y").agg(F.count_distinct("ord").cast("int").alias("n"))
    whole = layers.join(counts, ["z", "x", "y"]).select(F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.col("ord").cast("long").alias("ord"), F.col("a").cast("double").alias("a"), F.col("c").cast("double").alias("c"), "n")
    source, sink, log = (new_folder(spark, f"seams-{n}") for n in ("in", "out", "log"))
    whole.repartition(batches, "ord").write.parquet(source)
    stream = spark.readStream.schema(LAYER).option("maxFilesPerTrigger", 1).parquet(source)
    running = assemble(stream).writeStream.format("parquet").option("path", sink).option("checkpointLocation", log).trigger(availableNow=True).start()
    running.awaitTermination()
    done = spark.read.schema(TILE).parquet(sink)
    if incomplete(counts, done).take(1):
        raise RuntimeError("some tiles never got all their layers")
    return done
