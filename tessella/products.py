"""Products: the stages that lead from fetched sheets to a tileset, a series at a time.

A series lives in one folder that all executors share: its GeoTIFFs, ``areas.json`` with what is
known of each sheet, and a folder for each stage (``healed``, ``upscaled``).  A stage makes what is
missing or older than its input; sheets are the unit of work, and of an upsampling their blocks.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.build import MapArea, MosaicSource, Polygon, build_mosaic
from tessella.functions.geo import LambertConformalConic
from tessella.functions.workers import arrow_map
from tessella.operators import detect, resample
from tessella.plans import catalog
from tessella.sources import tiff
from tessella.sources.folders import cut

MANIFEST = "areas.json"
FOLDERS = {"heal": "healed", "upsample": "upscaled"}


def _names(folder: str, series: dict) -> list[str]:
    there = sorted(os.listdir(folder)) if os.path.isdir(folder) else []
    return [n for n in there if catalog.wanted_into(n, series) == n]


def _manifest(folder: str) -> dict:
    path = os.path.join(folder, MANIFEST)
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _save(folder: str, entries: dict) -> None:
    path = os.path.join(folder, MANIFEST)
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(dict(sorted(entries.items())), f, indent=1)
    os.replace(f"{path}.part", path)


def _files(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """``sheet, content`` of a folder's files."""
    found = spark.read.format("binaryFile").load([os.path.join(folder, n) for n in names])
    return found.select(F.element_at(F.split(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), "/"), -1).alias("sheet"), "content")


def detect_areas(spark: SparkSession, folder: str, series: dict, names: list[str] | None = None) -> DataFrame:
    """Measure the sheets' map areas into the manifest; ``name, status, flagged`` of each.

    ``status`` is found, none or manual; manual entries are left as they are.  ``flagged`` names sides
    of a sectional sheet with much paper inside its area.
    """
    names = names or _names(folder, series)
    if not names:
        raise FileNotFoundError(f"no sheets in {folder}")
    entries = _manifest(folder)
    by_hand = [n for n in names if entries.get(n, {}).get("manual")]
    rest = [n for n in names if n not in by_hand]
    told = [(n, "manual", None) for n in by_hand]
    if rest:
        told += (_frames if series["detector"] == "frame" else _sectionals)(spark, folder, series, rest, entries)
        _save(folder, {k: v for k, v in entries.items() if v})
    return spark.createDataFrame(told, "name string, status string, flagged string")


def _frames(spark: SparkSession, folder: str, series: dict, names: list[str], entries: dict) -> list[tuple]:
    told = []
    for r in detect.frames(tiff.sampled(_files(spark, folder, names))).collect():  # a row per sheet
        entry = entries.setdefault(r.sheet, {})
        entry.pop("frame", None)
        entry.pop("include", None)
        if r.found:
            x0, y0, x1, y1 = r.outer if series["heal"] else r.clean
            entry["frame"] = {"outer": list(r.outer), "clean": list(r.clean)}
            entry["include"] = [{"pixel": [[x0, y0], [x1, y0], [x1, y1], [x0, y1]]}]
        told.append((r.sheet, "found" if r.found else "none", None))
    return told


def _sectionals(spark: SparkSession, folder: str, series: dict, names: list[str], entries: dict) -> list[tuple]:
    small = tiff.sampled(_files(spark, folder, names), detect.DECIMATE)
    paper = F.least("r", "g", "b") >= 250
    cells = cut(small.select("sheet", "col", "row", F.col("width").alias("cols"), F.col("height").alias("rows"), paper.alias("paper")), "paper")
    heads = [(n, tiff.read_header(os.path.join(folder, n)), entries.get(n, {}).get("open_sides", [])) for n in names]
    sheets = spark.createDataFrame([(n, h.width, h.height, sides) for n, h, sides in heads], "sheet string, width int, height int, open_sides array<string>")
    fits = cut(detect.sectional_fits(detect.collar_depths(cells), sheets), "fits")
    flagged = {r.sheet: r.sides for r in detect.paper_inside(cells, fits).where("flagged").groupBy("sheet").agg(F.array_join(F.array_sort(F.collect_set("side")), ", ").alias("sides")).collect()}
    told = []
    for r in detect.sectional_areas(fits).collect():  # a row per sheet
        entry = entries.setdefault(r.sheet, {})
        entry.pop("limits", None)
        entry.pop("include", None)
        if r.ring:
            entry["include"] = [{"pixel": [[p.x, p.y] for p in r.ring]}]
        told.append((r.sheet, "found" if r.ring else "none", flagged.get(r.sheet)))
    return told


def _todo(source: str, target: str, names: list[str], force: bool, beside: str | None = None) -> list[str]:
    """Names whose copy in ``target`` is missing or older than the source, or than the file ``beside``."""
    age = lambda path: os.path.getmtime(path)
    floor = age(beside) if beside else 0.0
    made = lambda n: os.path.join(target, n)
    return [n for n in names if force or not os.path.isfile(made(n)) or age(made(n)) < max(age(os.path.join(source, n)), floor)]


def heal(spark: SparkSession, folder: str, series: dict, source: str | None = None, scale: int = 1, force: bool = False) -> DataFrame:
    """Repaint the frames of a series' sheets into the folder healed: ``name, error`` of those made now."""
    source = source or folder
    names, entries = _names(source, series), _manifest(folder)
    lacking = [n for n in names if "frame" not in entries.get(n, {})]
    if lacking:
        raise ValueError(f"no frame is known for {', '.join(lacking)}")
    target = os.path.join(folder, FOLDERS["heal"])
    os.makedirs(target, exist_ok=True)
    todo = _todo(source, target, names, force, os.path.join(folder, MANIFEST))
    rows = [(os.path.join(source, n), os.path.join(target, n), *([v * scale for v in entries[n]["frame"][k]] for k in ("outer", "clean"))) for n in todo]
    frame = spark.createDataFrame(rows, "source string, target string, outer array<int>, clean array<int>").repartition(max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, target, outer, clean in zip(*(batch.column(c).to_pylist() for c in ("source", "target", "outer", "clean")), strict=True):
                error = None
                try:
                    _heal_file(source, target, outer, clean)
                except (OSError, ValueError) as e:
                    error = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([os.path.basename(source)]), pa.array([error], pa.string())], ["name", "error"])

    return cut(arrow_map(frame, run, "name string, error string"), "healed")


def _heal_file(source: str, target: str, outer: list[int], clean: list[int]) -> None:
    with open(source, "rb") as f:
        data = f.read()
    h, side = tiff.header(data), 512
    healed = resample.heal_bands(lambda: tiff.bands(data, h, side), (h.width, h.height), outer, clean)
    writer = None
    for r, band in enumerate(healed):
        writer = writer or tiff.TiledWriter(target, h.width, h.height, side, tiff.georeference_tags(h))
        for c in range(writer.across):
            writer.put(r, c, band[:, c * side : (c + 1) * side])
    writer.close()


def upsample(spark: SparkSession, folder: str, series: dict, model: str | Callable[[np.ndarray], np.ndarray] = "bicubic", source: str | None = None, force: bool = False, windows: dict[str, tiff.Window] | None = None) -> DataFrame:
    """Double a series' sheets into the folder upscaled: ``name, blocks`` of those made now.

    ``windows`` cuts sheets, by name, to a window of their pixels first.
    """
    source = source or folder
    target = os.path.join(folder, FOLDERS["upsample"])
    os.makedirs(target, exist_ok=True)
    todo = _todo(source, target, _names(source, series), force)
    heads = {n: tiff.read_header(os.path.join(source, n)) for n in todo}
    if not todo:
        return spark.createDataFrame([], "name string, blocks long")
    named = spark.createDataFrame([(i, n) for i, n in enumerate(todo)], "ord long, sheet string")
    cuts = {i: (windows or {}).get(n) for i, n in enumerate(todo)}
    shapes = {i: tiff.size_of(heads[n], cuts[i]) for i, n in enumerate(todo)}
    blocks = tiff.raster_blocks(_files(spark, source, todo).join(named, "sheet"), resample.BLOCK, {i: w for i, w in cuts.items() if w})
    sizes = spark.createDataFrame([(i, *shapes[i]) for i in cuts], "ord long, width int, height int")
    doubled = resample.upsample(blocks, sizes, model)
    plan = {i: (os.path.join(target, n), 2 * shapes[i][0], 2 * shapes[i][1], tiff.georeference_tags(heads[n], 2, (cuts[i] or (0, 0))[:2])) for i, n in enumerate(todo)}
    return cut(tiff.write_blocks(doubled, plan, 2 * resample.BLOCK), "upscaled").join(named, "ord").select(F.col("sheet").alias("name"), "blocks")


def required(folder: str, names: list[str], instead: str | None = None) -> list[str]:
    """Of files that are put there by hand those that are missing; none if the one that stands for all is there."""
    if instead and os.path.isfile(os.path.join(folder, instead)):
        return []
    return [n for n in names if not os.path.isfile(os.path.join(folder, n))]


def folder_of(folder: str, series: dict) -> str:
    """The folder of a series' last stage."""
    last = folder
    for stage in (["upsample"] if series["upsample_scale"] else []) + (["heal"] if series["heal"] else []):
        last = os.path.join(folder, FOLDERS[stage])
    return last


def check_stages(spark: SparkSession, folder: str, series: dict) -> None:
    """Refuse a stage whose output is missing or older than its input."""
    stages = [("", folder)] + [(s, os.path.join(folder, FOLDERS[s])) for s in ((["upsample"] if series["upsample_scale"] else []) + (["heal"] if series["heal"] else []))]
    if len(stages) == 1:
        return
    rows = [(stage, n, os.path.getmtime(os.path.join(where, n))) for stage, where in stages for n in _names(where, series)]
    files = spark.createDataFrame(rows, "stage string, name string, mtime double")
    old = catalog.chained(files, [s for s, _ in stages]).orderBy("stage", "name").first()
    if old is not None:
        raise ValueError(f"{old.name}: stage {old.stage} is {'missing' if old.missing else 'out of date'}")


def sources_of(folder: str, series: dict, where: str | None = None, detail: bool = False, crs: LambertConformalConic | None = None) -> list[MosaicSource]:
    """A series' sheets in order of name, with their areas; an error names those without one."""
    where = where or folder_of(folder, series)
    names, entries = _names(where, series), _manifest(folder)
    if not names:
        raise FileNotFoundError(f"no sheets in {where}")
    lacking = [n for n in names if n not in entries]
    if lacking:
        raise ValueError(f"no map area is known for {', '.join(lacking)}")
    scale = max(1, series["upsample_scale"]) if where != folder else 1
    return [MosaicSource(os.path.join(where, n), area_of(entries[n], scale), detail, crs) for n in names]


def area_of(entry: dict, scale: float = 1.0) -> MapArea:
    """A manifest's entry as a map area; what is in pixels is scaled."""
    limits = entry.get("limits", {})

    def polygons(kind: str) -> tuple[Polygon, ...]:
        found = [(frame, points) for p in entry.get(kind, []) for frame, points in p.items() if frame in ("pixel", "lonlat")]
        return tuple(Polygon(frame, tuple((x * scale, y * scale) if frame == "pixel" else (x, y) for x, y in points)) for frame, points in found)

    return MapArea(tuple(limits.get(k) for k in ("west", "south", "east", "north")), polygons("include"), polygons("exclude"))


def build(spark: SparkSession, name: str, root: str, out: str, *, only: list[str] | None = None, reverse: bool | None = None, charts: str | None = None, detail: bool = True, max_zoom: int | None = None, detail_zoom: int | None = None, crs: LambertConformalConic | None = None, **options) -> dict:
    """The tileset of a series, or of a composite one its members in paint order; each in the folder ``root/name``.

    ``only`` keeps sheets whose names begin so; ``charts`` takes the sheets of one folder instead
    of the last stage's, which is then not checked.
    """
    series = catalog.one(name)
    layers: list[MosaicSource] = []
    for member in [catalog.one(n) for n in series["layers"]] or [series]:
        folder = os.path.join(root, member["name"])
        if charts is None:
            check_stages(spark, folder, member)
        sheets = sources_of(folder, member, charts, member["name"] in series["detail_layers"], crs)
        sheets = [s for s in sheets if not only or os.path.basename(s.path).startswith(tuple(only))]
        layers += sheets[::-1] if (member["reverse"] if reverse is None else reverse) else sheets
    if not layers:
        raise ValueError(f"no sheet's name begins with {' or '.join(only or [])}")
    finer = detail_zoom if detail_zoom is not None else series["detail_zoom"]
    wanted = detail and finer is not None and any(s.detail for s in layers)
    return build_mosaic(spark, layers, out, max_zoom=series["max_zoom"] if max_zoom is None else max_zoom, detail_zoom=finer if wanted else None, title=options.pop("title", series["title"]), **options)

