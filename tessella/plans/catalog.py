"""The catalog of chart series and the questions asked of it: names, stages, order, staleness."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions import text

#: The five series.
SERIES = [
    {"name": "sectionals", "title": "FAA VFR Sectionals", "zip": r".+\.zip", "tif": r".+\.tif", "exclude": ["Mariana Islands Inset SEC.tif", "Samoan Islands Inset SEC.tif"], "detector": "sectional", "upsample_scale": 2, "max_zoom": 12},
    {"name": "ifr-low", "title": "FAA IFR Enroute Low (CONUS)", "zip": r"ENR_L\d\d\.zip", "tif": r"ENR_L\d\d[NS]?\.tif", "pdf_zip": r"DELUS\d{1,2}\.zip", "pdf": r"ENR_L\d\d\.pdf", "detector": "frame", "pdf_scale": 4, "reverse": True, "heal": True, "lossless": True, "max_zoom": 13},
    {"name": "ifr-high", "title": "FAA IFR Enroute High (CONUS)", "zip": r"ENR_H\d\d\.zip", "tif": r"ENR_H\d\d\.tif", "pdf_zip": r"DEHUS\d{1,2}\.zip", "pdf": r"ENR_H\d\d\.pdf", "detector": "frame", "pdf_scale": 4, "lossless": True, "max_zoom": 12},
    {"name": "tac", "title": "FAA VFR Terminal Area Charts", "zip": r".+_TAC\.zip", "tif": r".+ TAC\.tif", "detector": "sectional", "upsample_scale": 2, "max_zoom": 13},
    {"name": "sectionals-tac", "title": "FAA VFR Sectionals with Terminal Area Charts", "layers": ["sectionals", "tac"], "detail_layers": ["tac"], "max_zoom": 12, "detail_zoom": 13},
]
SCHEMA = "name string, title string, zip string, tif string, pdf_zip string, pdf string, exclude array<string>, detector string, pdf_scale int, upsample_scale int, heal boolean, reverse boolean, lossless boolean, max_zoom int, detail_zoom int, layers array<string>, detail_layers array<string>"
DEFAULTS = {"zip": "", "tif": "", "pdf_zip": "", "pdf": "", "exclude": [], "detector": None, "pdf_scale": 0, "upsample_scale": 0, "heal": False, "reverse": False, "lossless": False, "detail_zoom": None, "layers": [], "detail_layers": []}


def series(spark: SparkSession) -> DataFrame:
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple((DEFAULTS | s)[n] for n in names) for s in SERIES], SCHEMA)


def one(name: str) -> dict:
    found = [DEFAULTS | s for s in SERIES if s["name"] == name]
    if not found:
        raise ValueError(f"no series {name}; there are {', '.join(s['name'] for s in SERIES)}")
    return found[0]


def wants(name: Column, row: dict, kind: str) -> Column:
    """Whether a series takes a file of ``kind`` (zip, tif, pdf_zip, pdf) with this name."""
    match = text.full_match(name, row[kind])
    return match & ~text.excluded(name, row["exclude"]) if kind == "tif" else match


def wanted_into(name: str, row: dict) -> str | None:
    """Where a series keeps a file of this name, if it does: GeoTIFFs in its folder, PDFs in the folder pdf."""
    fits = lambda kind: bool(row[kind]) and re.fullmatch(row[kind], name, re.IGNORECASE) is not None
    if name.lower().endswith((".tif", ".tiff")):
        return name if fits("tif") and name not in row["exclude"] else None
    return f"pdf/{name}" if name.lower().endswith(".pdf") and fits("pdf") else None


def fetches_tifs(pdf_scale: Column) -> Column:
    return pdf_scale == 0


def fetched(name: Column, row: dict) -> Column:
    """Whether an archive of this name is fetched: GeoTIFFs, or PDFs where a series renders those."""
    return wants(name, row, "pdf_zip") if row["pdf_scale"] else wants(name, row, "zip")


def stages(pdf_scale: Column, upsample_scale: Column, heal: Column) -> Column:
    """The stages of a series in order; each reads what the one before has written."""
    listed = F.array(F.when(pdf_scale > 0, "render"), F.when(upsample_scale > 0, "upsample"), F.when(heal, "heal"))
    return F.filter(listed, lambda s: s.isNotNull())


def pixel_scale(pdf_scale: Column, upsample_scale: Column) -> Column:
    """Pixels of the last stage for each pixel of the download."""
    return F.greatest(pdf_scale, F.lit(1)) * F.greatest(upsample_scale, F.lit(1))


def members(all_series: DataFrame) -> DataFrame:
    """Composite series with their members in paint order: ``name, layer, member, detail``."""
    return all_series.where(F.size("layers") > 0).select("name", F.posexplode("layers").alias("layer", "member"), "detail_layers").select("name", "layer", "member", F.array_contains("detail_layers", F.col("member")).alias("detail"))


def paint_order(sheets: DataFrame, layer: str = "layer", name: str = "name", reverse: str = "reverse") -> DataFrame:
    """``ord`` from the bottom up: layer by layer, by name within one, backwards where ``reverse``.

    One window orders all sheets of a product: some hundreds.
    """
    within = Window.partitionBy(layer).orderBy(name)
    back = Window.partitionBy(layer).orderBy(F.desc(name))
    place = F.when(F.col(reverse), F.row_number().over(back)).otherwise(F.row_number().over(within))
    sizes = sheets.groupBy(layer).count().withColumn("__before", F.coalesce(F.sum("count").over(Window.orderBy(layer).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    return sheets.withColumn("__place", place).join(sizes, layer).withColumn("ord", (F.col("__before") + F.col("__place") - 1).cast("long")).drop("__before", "__place")


def current_edition(links: DataFrame, today: Column, by: list[str], date: str = "date", link: str = "link") -> DataFrame:
    """Of each group the latest edition up to ``today``; the greater link on equal dates."""
    return links.where(F.col(date) <= today).groupBy(*by).agg(F.max(F.struct(date, link)).alias("e")).select(*by, f"e.{date}", f"e.{link}")


def stale(inputs: DataFrame, outputs: DataFrame, key: str, accept_equal: bool = False) -> DataFrame:
    """Inputs without an output, or with one that is older: ``key, missing``."""
    made = outputs.select(F.col(key).alias("__key"), F.col("mtime").alias("__made"))
    older = F.col("__made") <= F.col("mtime") if accept_equal else F.col("__made") < F.col("mtime")
    return inputs.join(made, F.col(key) == F.col("__key"), "left").where(F.col("__made").isNull() | older).select(key, F.col("__made").isNull().alias("missing"))


def missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(present.select(key), key, "left_anti")


def pdf_for(sheets: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Sheet stems with their PDF: the exact stem, else the stem without N or S at its end."""
    exact = pdfs.select(F.col("stem").alias("__exact"))
    short = pdfs.select(F.col("stem").alias("__short"))
    joined = sheets.join(exact, F.col("stem") == F.col("__exact"), "left").join(short, F.rtrim("stem", F.lit("NS")) == F.col("__short"), "left")
    return joined.select(*sheets.columns, F.coalesce("__exact", "__short").alias("pdf"))


def chosen(sheets: DataFrame, prefixes: list[str], name: str = "name") -> DataFrame:
    """The sheets whose name begins with one of ``prefixes``; all of them if there are none."""
    if not prefixes:
        return sheets
    begins = F.lit(False)
    for p in prefixes:
        begins = begins | F.col(name).startswith(p)
    return sheets.where(begins)


def chained(files: DataFrame, names: list[str], accept_equal: bool = True) -> DataFrame:
    """Stages ``names`` in order over ``files`` (stage, name, mtime): ``name, stage, missing`` of outputs to make anew.

    The first stage is what was downloaded; each later one is compared with the one before.
    """
    found = None
    for before, after in zip(names, names[1:], strict=False):
        of = lambda stage: files.where(F.col("stage") == stage).select("name", "mtime")
        wanted = files.where(F.col("stage") == names[0]).select("name")
        ready = of(before).join(wanted, "name", "left_semi")
        part = stale(ready, of(after), "name", not accept_equal).select("name", F.lit(after).alias("stage"), "missing")
        found = part if found is None else found.union(part)
    return found


def detectors(all_series: DataFrame) -> DataFrame:
    """One row: the names of all detectors, in order."""
    return all_series.agg(F.array_join(F.array_sort(F.collect_set("detector")), ", ").alias("detectors"))
