"""Sheets, points, chips, requests, editions and files derived from the star schema's tables.

There are no rasters among the tables, so geometry comes from keys by whole-number arithmetic;
``SQL`` has the same views for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes in degrees with paint order, detail flag, alpha and a gray value."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as ord",
        "cast((s_suppkey * 37) % 300 - 150 as double) as west",
        "cast((s_suppkey * 53) % 120 - 60 as double) as south",
        "cast((s_suppkey * 37) % 300 - 150 + 6 + s_suppkey % 7 as double) as east",
        "cast((s_suppkey * 53) % 120 - 60 + 4 + s_suppkey % 5 as double) as north",
        "s_suppkey % 10 = 0 as detail",
        "case s_suppkey % 3 when 0 then 1.0D when 1 then 0.5D else 0.25D end as a",
        "(s_suppkey * 97) % 256 as c",
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "-180 + ((event_id * 7919) % 36000) / 100D as lon", "-80 + ((event_id * 104729) % 16000) / 100D as lat", "cast(event_id % 13 as int) as z")


def chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of 8 by 8 tiles: ``vec_id, z, x, y, px, py, c, a``."""
    exploded = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "posexplode(embedding) as (pos, v)")
    return exploded.selectExpr(
        "vec_id",
        "cast(8 as int) as z",
        "vec_id % 64 as x",
        "vec_id div 64 as y",
        "cast(pos % 8 as int) as px",
        "cast(pos div 8 as int) as py",
        "cast(rint(least(greatest((cast(v as double) + 0.5D) * 255, 0D), 255D)) as int) as c",
        "cast((vec_id + pos) % 5 * 63 as int) as a",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile requests; one of nine is for something else."""
    base = table(spark, sf_dir, "events").selectExpr("event_id", "ts", "user_id", "event_type", "cast(get_json_object(props, '$.k') as bigint) % 8 as k", "case when event_id % 11 = 0 then 0 else (event_id * 31) % 5000 end as encoded")
    return base.selectExpr(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "case when event_id % 9 = 4 then '/viewer.html' else concat('/tiles/', k, '/', event_id % shiftleft(1, cast(k as int)), '/', (event_id div 7) % shiftleft(1, cast(k as int)), '.webp') end as url",
        "case when event_id % 11 = 0 or event_id % 4 = 0 then 0 else encoded + 300 end as transfer",
        "encoded",
        "encoded * 3 as decoded",
    )


SQL = {
    "sheets": """
        SELECT s_suppkey AS ord, CAST((s_suppkey * 37) % 300 - 150 AS DOUBLE) AS west, CAST((s_suppkey * 53) % 120 - 60 AS DOUBLE) AS south,
               CAST((s_suppkey * 37) % 300 - 150 + 6 + s_suppkey % 7 AS DOUBLE) AS east, CAST((s_suppkey * 53) % 120 - 60 + 4 + s_suppkey % 5 AS DOUBLE) AS north,
               s_suppkey % 10 = 0 AS detail, CAST(CASE s_suppkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 ELSE 0.25 END AS DOUBLE) AS a, (s_suppkey * 97) % 256 AS c
        FROM supplier""",
    "points": """
        SELECT event_id, -180 + ((event_id * 7919) % 36000) / CAST(100 AS DOUBLE) AS lon, -80 + ((event_id * 104729) % 16000) / CAST(100 AS DOUBLE) AS lat, CAST(event_id % 13 AS INTEGER) AS z
        FROM events""",
    "chips": """
        SELECT vec_id, 8 AS z, vec_id % 64 AS x, vec_id // 64 AS y, CAST(pos % 8 AS INTEGER) AS px, CAST(pos // 8 AS INTEGER) AS py,
               CAST(round_even(least(greatest((CAST(embedding[pos + 1] AS DOUBLE) + 0.5) * 255, 0), 255), 0) AS INTEGER) AS c, CAST((vec_id + pos) % 5 * 63 AS INTEGER) AS a
        FROM embeddings, range(64) AS r(pos)""",
    "requests": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_id % 9 = 4 THEN '/viewer.html' ELSE concat('/tiles/', k, '/', event_id % (1 << CAST(k AS INTEGER)), '/', (event_id // 7) % (1 << CAST(k AS INTEGER)), '.webp') END AS url,
               CASE WHEN event_id % 11 = 0 OR event_id % 4 = 0 THEN 0 ELSE encoded + 300 END AS transfer, encoded, encoded * 3 AS decoded
        FROM (SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 8 AS k,
                     CASE WHEN event_id % 11 = 0 THEN 0 ELSE (event_id * 31) % 5000 END AS encoded FROM events)""",
}


def with_views(sql: str, *names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " " + sql
