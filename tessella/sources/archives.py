"""Chart archives, listings and manifests."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.workers import arrow_map
from tessella.plans import area
from tessella.plans.catalog import wants


def members(spark: SparkSession, path: str) -> DataFrame:
    """``archive, name, content`` of every file in zip archives; folders in names are dropped."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as packed:
                    for info in packed.infolist():
                        if not info.is_dir():
                            name = info.filename.rsplit("/", 1)[-1]
                            yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([name]), pa.array([packed.read(info)], pa.binary())], ["archive", "name", "content"])

    return arrow_map(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content"), read, "archive string, name string, content binary")


def routed(files: DataFrame, series: dict) -> DataFrame:
    """The members a series takes: GeoTIFFs to its folder, PDFs to the folder pdf in it."""
    name = F.col("name")
    tif = name.rlike(r"(?i)\.tiff?$") & wants(name, series, "tif")
    pdf = name.rlike(r"(?i)\.pdf$") & wants(name, series, "pdf")
    return files.where(tif | pdf).withColumn("target", F.when(pdf, F.concat(F.lit("pdf/"), name)).otherwise(name))


def manifest(spark: SparkSession, path: str, scale: float = 1.0) -> DataFrame:
    """``sheet, area`` of an area manifest; pixel polygons times ``scale``."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(area.from_manifest(F.col("value"), F.lit(scale))).alias("sheet", "area"))


def frames(spark: SparkSession, path: str, scale: float = 1.0) -> DataFrame:
    """``sheet, outer, clean, manual`` of a frame manifest, in pixels times ``scale``."""
    kind = "map<string,struct<frame:struct<outer:array<double>,clean:array<double>>,manual:boolean>>"
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("sheet", "e"))
    scaled = lambda c: F.transform(c, lambda v: F.rint(v * scale).cast("int"))
    return whole.select("sheet", scaled(F.col("e.frame.outer")).alias("outer"), scaled(F.col("e.frame.clean")).alias("clean"), F.coalesce("e.manual", F.lit(False)).alias("manual"))


def manifest_text(rows: DataFrame, key: str, value: str, by: list[str] | None = None) -> DataFrame:
    """One row for each group ``by`` (a folder of sheets): a manifest with its sheets in order of name, as JSON.

    A manifest is one file, so a group is bounded by what a file holds.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value))))
    return rows.groupBy(*(by or [])).agg(F.to_json(F.map_from_entries(entries)).alias("manifest"))
