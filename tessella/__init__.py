"""Map-tile pyramids from georeferenced sheets, as Spark DataFrames."""

from importlib import import_module

#: Public names and the modules that hold them; a module is imported when one of its names is asked for.
_HOMES = {
    "tessella.build": ("MapArea", "MosaicSource", "Polygon", "TileBuildError", "build_mosaic", "build_tileset"),
    "tessella.functions.geo": ("LambertConformalConic",),
    "tessella.functions.grid": ("GEOGRAPHIC", "MERCATOR", "Scheme"),
    "tessella.sources.tiff": ("GeoReferenceError", "copy_georeference"),
}
__all__ = sorted(n for names in _HOMES.values() for n in names)


def __getattr__(name: str) -> object:
    for home, names in _HOMES.items():
        if name in names:
            return getattr(import_module(home), name)
    raise AttributeError(name)
