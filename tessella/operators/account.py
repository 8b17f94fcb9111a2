"""Accounting of tile requests; the same aggregates serve tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import request_class, tile_of_url


def classified(requests: DataFrame, prefix: str = "") -> DataFrame:
    """Requests for tiles with ``z, x, y`` and ``class``; others are left out."""
    tile = requests.withColumn("__t", tile_of_url(F.col("url"), prefix)).where("__t is not null")
    return tile.select(*requests.columns, "__t.z", "__t.x", "__t.y", request_class(F.col("transfer"), F.col("encoded"), F.col("decoded")).alias("class"))


def totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by class, bytes on the wire, payload of downloads, bytes of imagery."""
    of = lambda name: F.count_if(F.col("class") == name)
    return rows.groupBy(*keys).agg(of("downloaded").alias("downloaded"), of("cached").alias("cached"), of("opaque").alias("opaque"), F.sum("transfer").alias("network"), F.sum(F.when(F.col("class") == "downloaded", F.col("encoded")).otherwise(0)).alias("payload"), F.sum("decoded").alias("imagery"))


def by_level(rows: DataFrame) -> DataFrame:
    return rows.groupBy("z").agg(F.count("*").alias("requests"))


def average_tile(sums: DataFrame) -> DataFrame:
    """``sums`` with ``average``: payload for each download; null without downloads."""
    return sums.withColumn("average", F.when(F.col("downloaded") > 0, F.round(F.col("payload") / F.col("downloaded"))).cast("long"))


def last_tile(rows: DataFrame, keys: list[str], time: str = "ts", tie: str = "event_id") -> DataFrame:
    """Per group the tile asked for last."""
    return rows.groupBy(*keys).agg(F.max_by(F.concat_ws("/", "z", "x", "y"), F.struct(time, tie)).alias("last"))


def visible(rows: DataFrame) -> DataFrame:
    """Per level: distinct tiles and their bounding box."""
    return rows.groupBy("z").agg(F.count_distinct("x", "y").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


def progress(steps: DataFrame, keys: list[str], order: str, elapsed: str) -> DataFrame:
    """Per group and step: steps ``done``, ``rate`` so far, and ``eta`` for the rest at that rate."""
    within = Window.partitionBy(*keys)
    done = steps.withColumn("done", F.row_number().over(within.orderBy(order)).cast("long")).withColumn("__total", F.count("*").over(within))
    rest = (F.col("__total") - F.col("done")) * F.col(elapsed) / F.col("done")
    return done.withColumn("rate", F.col("done") / F.col(elapsed)).withColumn("eta", rest).drop("__total")


def visible_labels(seen: DataFrame) -> DataFrame:
    """:func:`visible` as text by level: how many tiles, and the ranges of their columns and rows."""
    span = lambda name: F.concat(F.col(f"{name}0").cast("string"), F.when(F.col(f"{name}1") > F.col(f"{name}0"), F.concat(F.lit("-"), F.col(f"{name}1").cast("string"))).otherwise(""))
    return seen.select(F.concat(F.lit("z"), F.col("z").cast("string")).alias("level"), F.concat(F.col("n").cast("string"), F.lit(" \u00d7  x "), span("x"), F.lit("  y "), span("y")).alias("label"))


def worth_noting(status: Column, described: Column) -> Column:
    """Whether a failed request says anything: where a tileset is described, a missing tile is only an empty place."""
    return (status >= 400) & ~((status == 404) & described)


def exits(runs: DataFrame, names: str = "names", codes: str = "codes") -> DataFrame:
    """Runs of several processes (arrays of names and exit codes) with ``failed``: the names that did not end well."""
    bad = F.filter(F.arrays_zip(F.col(names).alias("name"), F.col(codes).alias("code")), lambda p: p["code"] != 0)
    return runs.withColumn("failed", F.array_join(F.array_sort(F.transform(bad, lambda p: p["name"])), ", "))
