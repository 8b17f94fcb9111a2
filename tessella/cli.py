"""Command line: fetch, detect, heal, upsample and build products; build a tileset; copy a georeference; list and serve tilesets."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="tessella", description=__doc__)
    commands = main.add_subparsers(dest="command", required=True)

    def zooms(command: argparse.ArgumentParser) -> None:
        command.add_argument("--min-zoom", type=int, default=0)
        command.add_argument("--max-zoom", type=int)
        command.add_argument("--detail-zoom", type=int)
        command.add_argument("--resampling", default="cubic")
        command.add_argument("--tolerance", type=float, default=0.0, help="source pixels a coordinate may be off")
        command.add_argument("--resume", action="store_true")
        command.add_argument("--overwrite", action="store_true")
        command.add_argument("--title")

    build = commands.add_parser("build", help="tiles from TIFFs, later ones on top")
    build.add_argument("sources", nargs="+")
    build.add_argument("out")
    zooms(build)
    build.add_argument("--scheme", default="mercator")
    build.add_argument("--detail", action="append", default=[], help="name of a detail sheet")
    build.add_argument("--bbox", type=float, nargs=4, metavar=("WEST", "SOUTH", "EAST", "NORTH"))
    build.add_argument("--bbox-crs", default="EPSG:4326", help="or: source, for a single sheet")
    build.add_argument("--skip-blank", action="store_true")
    fetch = commands.add_parser("fetch", help="archives of a series into its folder")
    fetch.add_argument("series")
    fetch.add_argument("folder")
    fetch.add_argument("urls", nargs="+")
    for name, text in (("detect", "measure map areas into the manifest"), ("heal", "repaint frames"), ("upsample", "double the sheets")):
        stage = commands.add_parser(name, help=text)
        stage.add_argument("series")
        stage.add_argument("folder")
        stage.add_argument("--source", help="folder of the stage before, if not the series' own")
        stage.add_argument("--force", action="store_true", help="make anew what is up to date")
        stage.add_argument("--model", default="bicubic", help="of an upsampling")
        stage.add_argument("charts", nargs="*")
    product = commands.add_parser("product", help="the tileset of a series")
    product.add_argument("series")
    product.add_argument("root", help="folder of the series' folders")
    product.add_argument("out")
    zooms(product)
    product.add_argument("--charts", help="take the sheets of this folder")
    product.add_argument("--only", nargs="+", help="beginnings of sheets' names")
    product.add_argument("--reverse-order", action=argparse.BooleanOptionalAction)
    product.add_argument("--detail", action=argparse.BooleanOptionalAction, default=True)
    copy = commands.add_parser("georef", help="give an image another file's georeference")
    copy.add_argument("reference")
    copy.add_argument("image")
    copy.add_argument("output")
    copy.add_argument("--overwrite", action="store_true")
    copy.add_argument("--any-size", action="store_true")
    copy.add_argument("--copy-nodata", action="store_true")
    listing = commands.add_parser("list", help="tilesets in a folder, as JSON")
    listing.add_argument("root")
    listing.add_argument("--write", action="store_true", help="into tilesets.json of the folder")
    serve = commands.add_parser("serve", help="a folder of tilesets on the web")
    serve.add_argument("root")
    serve.add_argument("--host", default="127.0.0.1")
    serve.add_argument("--port", type=int, default=8000)
    return main


def _zooms(args: argparse.Namespace) -> dict:
    return {k: getattr(args, k) for k in ("min_zoom", "max_zoom", "detail_zoom", "resampling", "tolerance", "resume", "overwrite", "title")}


def _told(found: dict) -> None:
    print(json.dumps({k: found[k] for k in ("tiles", "bytes", "minzoom", "maxzoom")}))


def _build(spark: SparkSession, args: argparse.Namespace) -> int:
    from tessella.build import MapArea, MosaicSource, build_mosaic, build_tileset

    if len(args.sources) == 1 and not args.detail:
        _told(build_tileset(spark, args.sources[0], args.out, bbox=tuple(args.bbox) if args.bbox else None, bbox_crs=args.bbox_crs, scheme=args.scheme, skip_blank=args.skip_blank, **_zooms(args)))
        return 0
    area = MapArea(limits=tuple(args.bbox) if args.bbox else (None, None, None, None))
    sources = [MosaicSource(p, area, os.path.basename(p) in args.detail) for p in args.sources]
    _told(build_mosaic(spark, sources, args.out, scheme=args.scheme, **_zooms(args)))
    return 0


def _fetch(spark: SparkSession, args: argparse.Namespace) -> int:
    from tessella.plans.catalog import one
    from tessella.sources.fetch import fetch, outcome
    from tessella.sources.folders import cut

    done = cut(fetch(spark, args.urls, one(args.series), args.folder), "fetched")
    row = outcome(done).first()
    print(json.dumps(row.asDict()))
    return 1 if row.failed else 0


def _stage(spark: SparkSession, args: argparse.Namespace) -> int:
    from tessella import products
    from tessella.plans.catalog import one

    series = one(args.series)
    if args.command == "detect":
        found = products.detect_areas(spark, args.folder, series, args.charts or None)
    elif args.command == "heal":
        found = products.heal(spark, args.folder, series, args.source, force=args.force)
    else:
        found = products.upsample(spark, args.folder, series, args.model, args.source, args.force)
    rows = [r.asDict() for r in found.orderBy("name").collect()]  # a row per sheet
    print(json.dumps(rows))
    return 1 if any(r.get("error") or r.get("status") == "none" for r in rows) else 0


def _product(spark: SparkSession, args: argparse.Namespace) -> int:
    from tessella import products

    options = {k: v for k, v in _zooms(args).items() if not (k == "title" and v is None)}
    _told(products.build(spark, args.series, args.root, args.out, only=args.only, reverse=args.reverse_order, charts=args.charts, detail=args.detail, **options))
    return 0


def _list(spark: SparkSession, args: argparse.Namespace) -> int:
    from tessella.operators.discover import tilesets

    places = [("", args.root)] + [(n, os.path.join(args.root, n)) for n in sorted(os.listdir(args.root))]
    files = []
    for name, folder in places:
        path = os.path.join(folder, "metadata.json")
        if os.path.isfile(path):
            with open(path, encoding="utf-8") as f:
                files.append((name, f.read()))
    found = json.dumps([r.asDict() for r in tilesets(spark.createDataFrame(files, "folder string, content string")).collect()])
    print(found)
    if args.write:
        with open(os.path.join(args.root, "tilesets.json"), "w", encoding="utf-8") as f:
            f.write(found)
    return 0


COMMANDS = {"build": _build, "fetch": _fetch, "detect": _stage, "heal": _stage, "upsample": _stage, "product": _product, "list": _list}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        if args.command == "georef":
            from tessella.sources.tiff import copy_georeference

            print(copy_georeference(args.reference, args.image, args.output, overwrite=args.overwrite, strict_size=not args.any_size, copy_nodata=args.copy_nodata))
            return 0
        if args.command == "serve":
            from tessella.serve import server

            server(args.root, args.host, args.port).serve_forever()
            return 0
        return COMMANDS[args.command](SparkSession.builder.appName("tessella").getOrCreate(), args)
    except (OSError, ValueError, RuntimeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
